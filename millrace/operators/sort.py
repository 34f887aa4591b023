"""Ordering, newest-of, and repeatable samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.project import as_list, quoted
from millrace.operators.windows import row_hash


def sort(df: DataFrame, keys: str | Sequence[str], descending: bool = False) -> DataFrame:
    """Total order with one direction for all keys.

    Equal keys are ordered by the rows' content: repeatable, and a hot key spreads over several range partitions.
    """
    columns = [quoted(k) for k in as_list(keys)]
    ordered = [c.desc() for c in columns] if descending else [c.asc() for c in columns]
    return df.orderBy(*ordered, row_hash(df))


def latest(df: DataFrame, column: str, condition: Column | str, default: object = None) -> DataFrame:
    """One row: the highest value of a column among the rows that meet a condition, or the default."""
    test = F.expr(condition) if isinstance(condition, str) else condition
    best = F.max(F.when(test, quoted(column)))
    if default is not None:
        best = F.coalesce(best, F.lit(str(default)).cast(df.schema[column].dataType))
    return df.agg(best.alias(column))


def hash_sample(df: DataFrame, keys: str | Sequence[str], size: int) -> DataFrame:
    """Up to `size` rows, spread evenly over the key space and the same on every run.

    Rows are ordered by a hash of their key's text; each task keeps its own lowest `size` before they are merged.
    """
    names = as_list(keys)
    text = F.concat_ws("|", *[F.coalesce(quoted(n).cast("string"), F.lit("\\N")) for n in names])
    return df.orderBy(F.md5(text), *[quoted(n) for n in names]).limit(size)


def sample_keys(df: DataFrame, keys: str | Sequence[str], size: int) -> DataFrame:
    """Up to `size` distinct keys."""
    names = as_list(keys)
    return hash_sample(df.select(*[quoted(n) for n in names]).distinct(), names, size)
