"""Row numbering: first row per key, global index, numbering inside hot groups, positional zip."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import to_column
from millrace.operators.project import as_list, quoted
from millrace.session import cut

# monotonically_increasing_id() keeps the partition above, and the position in it below, this bit.
POSITION_BITS = 33


def row_hash(df: DataFrame) -> Column:
    """A hash of a row's content, for breaking ties and spreading rows. Maps have no hash and are left out."""
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*[quoted(c) for c in hashed])


def group_select_first(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The first row of every key by an explicit order.

    Spark turns the rank filter into a per-task limit before the shuffle, so a hot key sends one row per map task
    and not the whole group. Rows that are equal in the order are told apart by their content, so a repeated or retried
    run picks the same row.
    """
    names = as_list(keys)
    if not order_by:
        raise ValueError("order_by is needed: without it the first row would be arbitrary")
    tied = df.withColumn("__tie", row_hash(df))
    window = Window.partitionBy(*[quoted(n) for n in names]).orderBy(*order_by, "__tie")
    return tied.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank", "__tie")


def row_index(df: DataFrame, order_by: Sequence[str | Column], name: str = "row_index", start: int = 1) -> DataFrame:
    """A gapless index over the whole table, in the given order, without a single-task window.

    Rows are range-partitioned and sorted, the result is materialised once, and each row's index is its position in
    its partition plus the sizes of the partitions before it. Ties in `order_by` are broken by the row's content, so
    rows with one value of a hot order column spread over several partitions.
    """
    placed = cut(
        df.withColumn("__tie", row_hash(df))
        .repartitionByRange(*order_by, "__tie")
        .sortWithinPartitions(*order_by, "__tie")
        .withColumn("__place", F.monotonically_increasing_id())
        .drop("__tie")
    )
    part = F.shiftright("__place", POSITION_BITS)
    position = F.col("__place").bitwiseAND((1 << POSITION_BITS) - 1)
    # One row per partition, however large the table is: small enough for one task and for a broadcast.
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + position + F.lit(start))
        .drop("__part", "__offset", "__place")
    )


def null_safe_equal(left: str, right: str, names: Iterable[str]) -> Column:
    conditions = [F.col(f"{left}.`{n}`").eqNullSafe(F.col(f"{right}.`{n}`")) for n in names]
    return reduce(lambda a, b: a & b, conditions)


def number_within_groups(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: Sequence[str],
    name: str = "row_number",
) -> DataFrame:
    """Number the rows of every group from 1, in order.

    Rows are numbered globally by (keys, order) over range partitions and the group's first index is subtracted, so a
    group of any size is split over tasks.
    """
    names = as_list(keys)
    indexed = row_index(df, [*names, *order_by], "__index")
    first = indexed.groupBy(*[quoted(n) for n in names]).agg(F.min("__index").alias("__first"))
    joined = indexed.alias("a").join(first.alias("b"), null_safe_equal("a", "b", names))
    return joined.select(
        *[F.col(f"a.`{c}`") for c in df.columns], (F.col("__index") - F.col("__first") + 1).alias(name)
    )


def positional_zip(
    left: DataFrame, right: DataFrame, left_order: Sequence[str | Column], right_order: Sequence[str | Column]
) -> DataFrame:
    """Put the n-th row of `right` beside the n-th row of `left`; surplus rows of the longer side are dropped.

    The order keys are required: the order of files in a folder is not one.
    """
    if not left_order or not right_order:
        raise ValueError("both sides need an order")
    numbered_left = row_index(left, left_order, "__position")
    numbered_right = row_index(right, right_order, "__position")
    return numbered_left.join(numbered_right, "__position").drop("__position")


def add_column(
    df: DataFrame,
    name: str,
    values: Sequence[object],
    data_type: T.DataType | str,
    order_by: Sequence[str | Column],
) -> DataFrame:
    """Attach a list of values, the n-th value to the n-th row in the given order; as many values as rows are needed."""
    rows = df.count()
    if rows != len(values):
        raise ValueError(f"{len(values)} values for {rows} rows")
    kind = T.DataType.fromDDL(data_type) if isinstance(data_type, str) else data_type
    schema = T.StructType([T.StructField("__position", T.LongType()), T.StructField(name, kind)])
    column = df.sparkSession.createDataFrame(list(enumerate(values, start=1)), schema)
    return row_index(df, order_by, "__position").join(column, "__position").drop("__position")


def surrogate_keys(
    df: DataFrame, natural_keys: str | Sequence[str], name: str, existing: DataFrame | None = None
) -> DataFrame:
    """Give every row a new integer key, continuing after the highest key of `existing`.

    Keys are handed out in the order of the natural key, so the same input gives the same keys.
    """
    start = 0
    if existing is not None:
        start = existing.agg(F.max(quoted(name)).cast("long")).first()[0] or 0
    keyed = row_index(df, [quoted(n) for n in as_list(natural_keys)], name, start=start + 1)
    return keyed.select(name, *df.columns)


def latest_rows(df: DataFrame, group: Column | str, version: Column | str) -> DataFrame:
    """Rows that carry their group's highest version; all of them, when several do. NULL groups have none.

    The maximum is aggregated map-side and joined back: an inner join, which adaptive execution can split on a hot
    group, as it could not split a window.
    """
    tagged = df.withColumns({"__group": to_column(group), "__version": to_column(version)})
    newest = tagged.groupBy("__group").agg(F.max("__version").alias("__version"))
    return tagged.join(newest, ["__group", "__version"]).drop("__group", "__version")
