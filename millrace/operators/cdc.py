"""Change data capture: merge an increment into a target.

Spark's Parquet tables have no MERGE, so each merge is "target rows nobody touched" plus "new versions". The first part
is an anti-join against the distinct touched keys: a small increment is broadcast by Spark itself, a large one is
joined by sort-merge with hot target keys split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.columns import any_of
from millrace.operators.filters import DELETES, INSERTS, UPDATES, change_types
from millrace.operators.joins import anti_join, semi_join
from millrace.operators.project import as_list, drop_technical_columns, quoted
from millrace.operators.sets import complement
from millrace.operators.windows import row_hash

# Fixed value: the column that tells when a row was loaded.
LOAD_TIMESTAMP = "etl_insert_ts"


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*[quoted(k) for k in as_list(keys)]).count().filter("count > 1")


def require_unique_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The table itself, or an error that names a repeated key."""
    repeated = duplicate_keys(df, keys).first()
    if repeated is not None:
        raise ValueError(f"repeated key in the increment: {repeated.asDict()}")
    return df


def newest_per_key(df: DataFrame, keys: str | Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """One row per key, the newest; equally new rows are told apart by their content, the same way on every run.

    Rows with a NULL in the key are no versions of one another and all stay. They are spread by their content and not
    gathered in one group. Tasks drop all but the newest rows before the shuffle.
    """
    names = as_list(keys)
    keyless = any_of(quoted(k).isNull() for k in names)
    content = row_hash(df)
    marked = df.withColumns({"__alone": F.when(keyless, content), "__tie": F.when(~keyless, content)})
    newest = [F.when(F.col("__alone").isNull(), quoted(c)).desc_nulls_last() for c in newest_by]
    window = Window.partitionBy(*[quoted(n) for n in names], "__alone").orderBy(*newest, "__tie")
    ranked = marked.withColumns({"__rank": F.rank().over(window), "__row": F.row_number().over(window)})
    kept = ranked.filter("__rank = 1 AND (__row = 1 OR __alone IS NOT NULL)")
    return kept.drop("__alone", "__tie", "__rank", "__row")


def untouched(
    target: DataFrame, touched: DataFrame, keys: str | Sequence[str], by_range: bool = False
) -> DataFrame:
    """Target rows whose key is not among the touched ones.

    With `by_range`, rows outside the touched range of the first key column pass by without a shuffle; the range comes
    from one small aggregate over the increment and is pushed into both scans of the target. Worth it where keys grow
    with time, so that an increment touches a narrow range, and the target is a stored table.
    """
    if not by_range:
        return anti_join(target, touched, keys)
    first = as_list(keys)[0]
    low, high = touched.agg(F.min(quoted(first)), F.max(quoted(first))).first()
    if low is None:
        return target
    kind = target.schema[first].dataType
    key = quoted(first)
    inside = key.between(F.lit(low).cast(kind), F.lit(high).cast(kind))
    outside = (key < F.lit(low).cast(kind)) | (key > F.lit(high).cast(kind)) | key.isNull()
    return target.filter(outside).union(anti_join(target.filter(inside), touched, keys))


def merge_by_indicator(
    target: DataFrame | None,
    incoming: DataFrame,
    keys: str | Sequence[str],
    indicator: str,
    by_range: bool = False,
) -> DataFrame:
    """Apply a change feed whose rows say UPD, INS or DEL.

    Updates without a match are inserted. Any non-NULL indicator removes the target row of its key, so deletes (and
    unknown indicators) take effect by omission; a NULL indicator changes nothing.
    """
    if target is None:
        # what is not a delete, without the feed's own columns, so that later loads fit
        alive = ~F.coalesce(quoted(indicator).isin(*DELETES), F.lit(False))
        return drop_technical_columns(incoming.filter(alive), indicator)
    touched = incoming.filter(quoted(indicator).isNotNull())
    changes = drop_technical_columns(change_types(incoming, indicator, UPDATES + INSERTS), indicator)
    return untouched(target, touched, keys, by_range).unionByName(changes)


def upsert(
    target: DataFrame | None, incoming: DataFrame, keys: str | Sequence[str], by_range: bool = False
) -> DataFrame:
    """New versions replace old ones of the same key; other rows stay."""
    if target is None:
        return incoming
    return untouched(target, incoming, keys, by_range).unionByName(incoming)


def append(target: DataFrame | None, incoming: DataFrame) -> DataFrame:
    return incoming if target is None else incoming.unionByName(target)


def merge_by_key(
    target: DataFrame | None,
    incoming: DataFrame,
    keys: str | Sequence[str],
    literal: bool = False,
    by_range: bool = False,
) -> DataFrame:
    """Upsert by primary key.

    With `literal`, what is taken out of the target are the rows equal to an incoming version, so that old and new
    versions of a changed row stand side by side.
    """
    if target is None or not literal:
        return upsert(target, incoming, keys, by_range)
    matched = semi_join(incoming, target, keys)
    return complement(target, matched).unionByName(incoming)


def unique_keys(incoming: DataFrame, keys: str | Sequence[str], newest_by: Sequence[str] = ()) -> DataFrame:
    """An increment in which a key comes once: its newest row by `newest_by`, else a repeated key is an error (found by one
    aggregate). Rows with a NULL in the key are no versions of one another."""
    if keys and newest_by:
        return newest_per_key(incoming, keys, newest_by)
    if keys:
        keyless = any_of(quoted(k).isNull() for k in as_list(keys))
        require_unique_keys(incoming.filter(~keyless), keys)
    return incoming


def merge(
    target: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str] = (),
    indicator: str | None = None,
    partition_column: str | None = None,
    literal: bool = False,
    by_range: bool = False,
    newest_by: Sequence[str] = (),
) -> DataFrame:
    """The merge that a pipeline's settings ask for.

    No target: the increment. Change indicator: apply it. Partition column: the increment alone, it goes to a partition
    of its own. Primary key: upsert. None of these: append. A change feed over a partitioned table changes several of its
    partitions: that is `sinks.partitions.merge_into_partitions`, and an error here.

    A key may come several times in an increment: see `unique_keys`.
    """
    if indicator and partition_column and target is not None:
        raise ValueError("a change feed over a partitioned table needs merge_into_partitions")
    incoming = unique_keys(incoming, keys, newest_by)
    if indicator:
        return merge_by_indicator(target, incoming, keys, indicator, by_range)
    if target is None or partition_column:
        return incoming
    if keys:
        return merge_by_key(target, incoming, keys, literal, by_range)
    return append(target, incoming)


def current_version_merge(
    target: DataFrame | None, incoming: DataFrame, keys: Sequence[str], loaded_at: datetime | str | Column
) -> DataFrame:
    """Upsert that stamps every row with the load time."""
    stamp = loaded_at if isinstance(loaded_at, Column) else F.lit(str(loaded_at)).cast("timestamp_ntz")
    merged = upsert(target.drop(LOAD_TIMESTAMP) if target is not None else None, incoming, keys)
    return merged.withColumn(LOAD_TIMESTAMP, stamp)


def full_load(target: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """The increment replaces the target."""
    return incoming


def upsert_or_reject(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], valid: Column, all_or_nothing: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Upsert the valid rows; return the result and the rejected rows.

    With `all_or_nothing` a single rejected row leaves the target as it was.
    """
    good = F.coalesce(valid, F.lit(False))
    rejected = incoming.filter(~good)
    if all_or_nothing and not rejected.isEmpty():
        return target, rejected
    return upsert(target, incoming.filter(good), keys), rejected


def daily_windows(spark: SparkSession, start: datetime | str, end: datetime | str) -> DataFrame:
    """One row per calendar day from start to end: `day`, `window_start`, `window_end`.

    The first window starts at the given time and the last one ends at the given time.
    """
    low, high = (F.lit(str(t)).cast("timestamp_ntz") for t in (start, end))
    days = spark.range(1).select(
        F.explode(F.sequence(low.cast("date"), high.cast("date"), F.expr("interval 1 day"))).alias("day")
    )
    midnight = F.col("day").cast("timestamp_ntz")
    return days.select(
        "day",
        F.greatest(midnight, low).alias("window_start"),
        F.least(midnight + F.expr("interval 1 day") - F.expr("interval 1 microsecond"), high).alias("window_end"),
    )


def rows_by_window(df: DataFrame, timestamp_column: str, windows: DataFrame) -> DataFrame:
    """Rows with the daily window they fall into. Windows and rows meet on the day, an equi-join."""
    low, high = windows.agg(F.min("window_start"), F.max("window_end")).first()  # known, so the scan can use them
    kind = df.schema[timestamp_column].dataType
    within = df.filter(quoted(timestamp_column).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
    dated = within.withColumn("day", quoted(timestamp_column).cast("date"))
    inside = quoted(timestamp_column).between(F.col("window_start"), F.col("window_end"))
    return dated.join(windows, "day").filter(inside)


def rows_per_window(df: DataFrame, timestamp_column: str, windows: DataFrame) -> DataFrame:
    """How many rows each window holds, zero included. Rows are counted per window before the outer join."""
    counted = rows_by_window(df, timestamp_column, windows).groupBy("day").agg(F.count(F.lit(1)).alias("row_count"))
    return windows.join(counted, "day", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("long")))
