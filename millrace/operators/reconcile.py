"""Source-to-target reconciliation, down to the cell."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import type_family
from millrace.operators.project import as_list, quoted
from millrace.operators.sets import presence
from millrace.operators.joins import semi_join
from millrace.operators.sort import sample_keys

# Texts that keep ('a', NULL) apart from (NULL, 'a') and ('ab', '') from ('a', 'b').
NULL_TEXT = "\\N"
SEPARATOR = "\x1f"


def full_row_key(df: DataFrame, columns: Sequence[str] | None = None, name: str = "full_key") -> DataFrame:
    """Add a digest over the row, for tables without a primary key. NULL has a text of its own."""
    parts = [F.coalesce(quoted(c).cast("string"), F.lit(NULL_TEXT)) for c in (columns or df.columns)]
    return df.withColumn(name, F.sha2(F.concat_ws(SEPARATOR, *parts), 256))


def two_way_difference(source: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct rows that only one table has, with `side` = 'source' or 'target'. One shuffle for both directions."""
    side = F.when(F.col("__right") == 0, F.lit("source")).otherwise(F.lit("target"))
    lonely = presence(source, target).filter("__left = 0 OR __right = 0")
    return lonely.select(*[quoted(c) for c in source.columns], side.alias("side"))


def key_presence(source: DataFrame, target: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Every distinct key with `found_in` = 'both', 'source' or 'target'."""
    names = as_list(keys)
    found = presence(source.select(*[quoted(n) for n in names]), target.select(*[quoted(n) for n in names]))
    where = (
        F.when(F.col("__right") == 0, F.lit("source"))
        .when(F.col("__left") == 0, F.lit("target"))
        .otherwise(F.lit("both"))
    )
    return found.select(*[quoted(n) for n in names], where.alias("found_in"))


def cell_mismatches(
    source: DataFrame, target: DataFrame, keys: str | Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Rows of common keys that differ: the key, the target's values, and the names of the differing columns.

    Source and target meet once, on the key. With `null_safe`, NULL against a value is a difference.
    """
    names = as_list(keys)
    others = [c for c in source.columns if c not in names and c in target.columns]

    def differs(column: str):
        a, b = F.col(f"s.`{column}`"), F.col(f"t.`{column}`")
        return ~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False))

    listed = F.array_compact(F.array(*[F.when(differs(c), F.lit(c)) for c in others]))
    left = source.select(*names, *others).alias("s")
    right = target.select(*names, *others).alias("t")
    joined = left.join(right, names).select(
        *[quoted(n) for n in names], *[F.col(f"t.`{c}`") for c in others], listed.alias("column_names")
    )
    return joined.filter(F.size("column_names") > 0)


def sampled_mismatches(
    source: DataFrame, target: DataFrame, keys: str | Sequence[str], size: int
) -> DataFrame:
    """Cell mismatches among `size` keys of the source, a sample spread over its keys, the same on every run.

    The sample comes first, and both sides are reduced to it before they are compared.
    """
    chosen = sample_keys(source, keys, size)
    return cell_mismatches(semi_join(source, chosen, keys), semi_join(target, chosen, keys), keys)


def no_mismatch(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: is there no row that only one side has?"""
    counted = two_way_difference(source, target).agg(F.count(F.lit(1)).alias("differing_rows"))
    return counted.select("differing_rows", (F.col("differing_rows") == 0).alias("no_mismatch"))


def metadata_check(inventory: DataFrame) -> DataFrame:
    """Per column of the inventory: source and target type family, and whether they agree."""
    source, target = type_family("source_datatype"), type_family("target_datatype")
    return inventory.select(
        "source_column_name",
        "target_column_name",
        "source_datatype",
        "target_datatype",
        source.alias("source_family"),
        target.alias("target_family"),
        (source == target).alias("matching"),
    )


def _plain_type(data_type: T.DataType) -> str:
    if isinstance(data_type, T.IntegralType):
        return "int"
    if isinstance(data_type, T.NumericType):
        return "decimal"
    return "string" if isinstance(data_type, T.StringType) else "timestamp"


def schema_inventory(source: DataFrame, target: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """An inventory for `metadata_check` from two tables and their (source, target) column pairs."""
    rows = [(a, b, _plain_type(source.schema[a].dataType), _plain_type(target.schema[b].dataType)) for a, b in pairs]
    return source.sparkSession.createDataFrame(
        rows, "source_column_name string, target_column_name string, source_datatype string, target_datatype string"
    )
