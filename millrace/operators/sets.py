"""Set operations and whole-table comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.project import quoted


def tagged_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both tables under the left columns, with two counters that tell the sides apart."""
    columns = [quoted(c) for c in left.columns]
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    a = left.select(*columns, one.alias("__left"), none.alias("__right"))
    b = right.select(*columns, none.alias("__left"), one.alias("__right"))
    return a.union(b)


def presence(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row of either table with how often each side has it.

    One aggregation, reduced map-side: a row with many copies costs one record per task. NULLs compare as equal.
    """
    grouped = tagged_union(left, right).groupBy(*[quoted(c) for c in left.columns])
    return grouped.agg(F.sum("__left").alias("__left"), F.sum("__right").alias("__right"))


def complement(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct left rows that the right table does not have (EXCEPT DISTINCT)."""
    return presence(left, right).filter("__left > 0 AND __right = 0").drop("__left", "__right")


def intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows that both tables have."""
    return presence(left, right).filter("__left > 0 AND __right > 0").drop("__left", "__right")


def union_by_name(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)


def union_by_position(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.union(b), tables)


def column_concat(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Put tables with one row per key side by side (full outer joins on the key)."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), tables)


def difference_count(actual: DataFrame, expected: DataFrame, mode: str = "bag") -> DataFrame:
    """One row: how many distinct rows differ. `bag` counts copies, `set` only asks whether a row is there."""
    if set(actual.columns) != set(expected.columns):
        raise ValueError("the tables have different columns")
    if mode not in ("bag", "set"):
        raise ValueError("mode must be 'bag' or 'set'")
    differs = "__left <> __right" if mode == "bag" else "(__left > 0) <> (__right > 0)"
    return presence(actual, expected).agg(F.count_if(F.expr(differs)).alias("differing_rows"))


def frames_equal(actual: DataFrame, expected: DataFrame, mode: str = "bag") -> DataFrame:
    """One row, one boolean column `equal`."""
    return difference_count(actual, expected, mode).select((F.col("differing_rows") == 0).alias("equal"))


def assert_frames_equal(actual: DataFrame, expected: DataFrame, message: str = "", mode: str = "bag") -> None:
    differing = difference_count(actual, expected, mode).first()[0]
    if differing:
        raise AssertionError(f"{message or 'tables differ'}: {differing} differing rows")
