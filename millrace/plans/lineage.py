"""Lineage records, the sources behind a table, and clean-up."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.session import cut

# The fields of a lineage record, and the name of the verb that ends a script.
LINEAGE = (
    "script_name string, exec_ts string, domain_name string, transformation_func_nm string, "
    "added_col array<string>, selected_cols array<string>, renamed_cols array<string>, dropped_cols array<string>, "
    "left_df_cols array<string>, left_df_id string, right_df_cols array<string>, right_df_id string, "
    "key_cols array<string>, left_key_cols array<string>, right_key_cols array<string>, final_df_cols array<string>, "
    "source_tables array<string>, target_tables string, sql_text string, transformed_df array<string>, "
    "final_path string"
)
FINAL = "Final"
FIELDS = [field.split(" ")[0] for field in LINEAGE.split(", ")]


def described(df: DataFrame) -> list[str]:
    """A table's columns as texts such as `('id', 'bigint')`."""
    return [str(pair) for pair in df.dtypes]


class LineageLog:
    """Collects one record per verb of a script. Frames go by the names the script gives them."""

    def __init__(self, spark: SparkSession, script_name: str, domain_name: str):
        self.spark = spark
        self.script_name = script_name
        self.domain_name = domain_name
        self.records: list[dict] = []

    def apply(self, verb: Callable[..., DataFrame], target: str, sources: Mapping[str, DataFrame], *args, **kwargs) -> DataFrame:
        """Run `verb(*source frames, *args, **kwargs)`, record it, and return its result.

        Extra record fields (such as `key_cols`) are given as `record={...}`.
        """
        extra = kwargs.pop("record", {})
        result = verb(*sources.values(), *args, **kwargs)
        names, frames = list(sources), list(sources.values())
        entry = {
            "transformation_func_nm": verb.__name__,
            "left_df_id": names[0] if names else "",
            "left_df_cols": described(frames[0]) if frames else [],
            "right_df_id": names[1] if len(names) > 1 else "",
            "right_df_cols": described(frames[1]) if len(frames) > 1 else [],
            "final_df_cols": described(result),
            "source_tables": names,
            "transformed_df": names,
            "target_tables": target,
            **(self.column_changes(frames[0], result) if len(frames) == 1 else {}),
            **extra,
        }
        self.add(entry)
        return result

    @staticmethod
    def column_changes(before: DataFrame, after: DataFrame) -> dict[str, list[str]]:
        """What a verb over one frame did to its columns."""
        return {
            "selected_cols": described(before),
            "added_col": [c for c in after.columns if c not in before.columns],
            "dropped_cols": [c for c in before.columns if c not in after.columns],
        }

    def finish(self, df: DataFrame, source: str, target: str, path: str) -> None:
        """The record that says where a script's result is stored."""
        self.add(
            {
                "transformation_func_nm": FINAL,
                "final_df_cols": described(df),
                "source_tables": [source],
                "transformed_df": [source],
                "target_tables": target,
                "final_path": path,
            }
        )

    def add(self, entry: Mapping[str, object]) -> None:
        unknown = set(entry) - set(FIELDS)
        if unknown:
            raise KeyError(f"no such lineage field: {', '.join(sorted(unknown))}")
        self.records.append(
            {
                "script_name": self.script_name,
                "exec_ts": str(datetime.now()),
                "domain_name": self.domain_name,
                **entry,
            }
        )

    def to_frame(self) -> DataFrame:
        return self.spark.createDataFrame([tuple(r.get(f) for f in FIELDS) for r in self.records], LINEAGE)


def edges_of(lineage: DataFrame) -> DataFrame:
    """(source, target), one row per input of every verb."""
    return lineage.select(F.explode("source_tables").alias("source"), F.col("target_tables").alias("target")).distinct()


def root_sources(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """For every target, the sources behind it that are derived from nothing: (target, source).

    Most edges lead from such sources, so only edges between derived tables are walked, and their paths double: a round knows
    the jumps of 2**k steps from every derived table, and what lies fewer steps behind the targets; one join with the jumps
    doubles both. So rounds grow with the logarithm of the longest path. Where walks go in circles, jumps never run out; then
    rounds end when they have gone as far as there are edges, as no path needs more steps. Sources come in by one join at the end.
    """
    plain = edges.select("source", "target").distinct()
    derived = plain.select(F.col("target").alias("node")).distinct().withColumn("derived", F.lit(True))
    marked = plain.join(derived, F.col("source") == F.col("node"), "left")
    marked = cut(marked.select("source", "target", F.coalesce("derived", F.lit(False)).alias("derived")))
    jumps = marked.filter("derived").select(F.lit(True).alias("jump"), F.col("target").alias("goal"), F.col("source").alias("node"))
    start = targets.select(F.lit(False).alias("jump"), F.col("target").alias("goal"), F.col("target").alias("node")).distinct()
    known, left = _counted_cut(jumps.unionByName(start))
    steps, most = 1, left
    while left and steps <= most:
        further = known.filter("jump").select(F.col("goal").alias("middle"), F.col("node").alias("behind"))
        reached = known.join(further, F.col("node") == F.col("middle")).select("jump", "goal", F.col("behind").alias("node"))
        known, left = _counted_cut(reached.unionByName(known.filter("NOT jump")).distinct())
        steps *= 2
    roots = marked.filter("NOT derived").select(F.col("target").alias("node"), "source")
    return known.filter("NOT jump").join(roots, "node").select(F.col("goal").alias("target"), "source").distinct()


def _counted_cut(known: DataFrame) -> tuple[DataFrame, int]:
    """The table as written, and how many jumps it has."""
    seen = Observation(f"lineage-{uuid.uuid4().hex}")
    written = cut(known.observe(seen, F.count_if("jump").alias("left")))
    return written, seen.get["left"]


def forget_script(lineage: DataFrame, script_name: str) -> DataFrame:
    """The lineage table without a script's records, ready to be written in place of it."""
    return lineage.filter(~F.col("script_name").eqNullSafe(F.lit(script_name)))
