"""Row filters."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import any_of, python_udf, seconds_of, to_column

# Change types of a feed, and the start of time for a first load.
UPDATES = ["UPD"]
INSERTS = ["INS"]
DELETES = ["DEL"]
FIRST_WATERMARK = datetime(1900, 1, 1)


def select_rows(df: DataFrame, condition: Column | str | Callable, *columns: str, vectorised: bool = False) -> DataFrame:
    """Rows for which the condition is true: a Column, an SQL text, or a Python function over the named columns (over pandas
    Series if `vectorised`)."""
    if callable(condition) and not isinstance(condition, Column):
        if not columns:
            raise ValueError("a Python function needs the columns it looks at")
        condition = python_udf(condition, "boolean", columns, vectorised)
    return df.filter(condition)


def incremental_window(
    df: DataFrame,
    timestamp_columns: Iterable[str],
    since: datetime | str | Column | None,
    until: datetime | str | Column,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Rows changed between two points in time by any of the timestamp columns, both ends included.

    Written as plain comparisons on the scanned columns, so the window reaches the Parquet or JDBC scan. With no
    `since` the window starts in 1900.
    """
    names = list(timestamp_columns)
    low = _bound(FIRST_WATERMARK if since is None else since)
    high = _bound(until)
    kept = df if columns is None else df.select(*{*columns, *names})
    if names:
        kept = kept.filter(any_of(_between(kept, name, low, high) for name in names))
    return kept if columns is None else kept.select(*columns)


def _bound(value: datetime | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value))


def _between(df: DataFrame, name: str, low: Column, high: Column) -> Column:
    # Cast the bounds and not the column: only then can the scan use the comparison.
    kind = df.schema[name].dataType
    return F.col(name).between(low.cast(kind), high.cast(kind))


def windowed_query(query: str, since: datetime | str | None, until: datetime | str, full_load_query: str) -> str:
    """Fill the two `{}` places of a user query; without an earlier run the full load takes its place."""
    if "{}" not in query:
        return query
    if since is None or since == "":
        return full_load_query
    for value in (since, until):
        query = query.replace("{}", str(value), 1)  # other braces are the query's own
    return query


def active_published(df: DataFrame) -> DataFrame:
    return df.filter((F.col("active").cast("string") == "true") & (F.col("status") == "published"))


def change_types(df: DataFrame, indicator: str, types: Iterable[str]) -> DataFrame:
    return df.filter(F.col(indicator).isin(*types))


def equal_or_all(df: DataFrame, column: str, value: str = "") -> DataFrame:
    """Rows of one class; '' means no filter."""
    return df if value == "" else df.filter(F.col(column) == value)


def within_horizon(df: DataFrame, column: str, as_of: date | str, months: int) -> DataFrame:
    """Rows dated up to `months` months after `as_of`."""
    return df.filter(F.col(column) <= horizon_end(df, column, as_of, months))


def horizon_end(df: DataFrame, column: str, as_of: date | str, months: int) -> Column:
    end = F.add_months(F.lit(str(as_of)).cast("date"), months)
    return end.cast(df.schema[column].dataType)


def contains_any(df: DataFrame, column: str, keywords: Iterable[str] = (), length: int | None = None) -> DataFrame:
    """Distinct values of a column that contain any of the keywords (no keyword: all).

    With `length` they are cut to so many characters before the distinct, so what is compared is what is returned.
    """
    words = list(keywords)
    col = F.col(column)
    hits = df.filter(any_of(col.contains(w) for w in words)) if words else df
    return hits.select((col if length is None else F.substring(col, 1, length)).alias(column)).distinct()


def lookup_exact(df: DataFrame, column: str, text: str, *result: str) -> DataFrame:
    """Rows whose value equals `text`, trailing blanks aside."""
    bare = text.rstrip(" ")
    # the prefix reaches the scan, the comparison of trimmed texts would not
    hits = df.filter(F.col(column).startswith(bare) & (F.rtrim(F.col(column)) == F.lit(bare)))
    return hits.select(*result) if result else hits


def sla_met(sla: str | Column, elapsed_seconds: str | Column) -> Column:
    """'true' when a run took less than its `HH:MM:SS`, 'not applicable' when none is set."""
    limit = to_column(sla)
    return (
        F.when(limit.isNull() | (F.trim(limit) == ""), F.lit("not applicable"))
        .when(seconds_of(limit) > to_column(elapsed_seconds), F.lit("true"))
        .otherwise(F.lit("false"))
    )
