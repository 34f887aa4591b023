"""Aggregations. Everything here reduces map-side before it shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.filters import horizon_end
from millrace.operators.project import as_list, quoted
from millrace.operators.windows import group_select_first, number_within_groups


def _in_parts(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], rows_per_part: int) -> DataFrame:
    """Add `part`: 0 for the first `rows_per_part` rows of a group, 1 for the next, and so on."""
    numbered = number_within_groups(df, keys, order_by, "__number")
    return numbered.withColumn("part", F.floor((F.col("__number") - 1) / rows_per_part)).drop("__number")


def pivot_aggregate_data(
    df: DataFrame,
    index: str | Sequence[str],
    column: str,
    values: str,
    rows_per_part: int,
    pivot_values: Sequence[object] | None = None,
) -> DataFrame:
    """Pivot to comma-joined lists, in the order of the values; the key of the result is (index, `part`).

    A cell of unlimited length would not fit into a task: every list goes on in further rows after `rows_per_part` values,
    counted by `part` from 0. Every value appears exactly once, and groups without any keep a row of empty lists. Without
    `pivot_values` a job finds them: they become columns, so they are few.
    """
    names = as_list(index)
    pivot_values = distinct_values(df, column) if pivot_values is None else pivot_values
    wanted = df.filter(quoted(column).isin(*pivot_values) & quoted(values).isNotNull()).select(*[quoted(c) for c in [*names, column, values]])
    groups = df.select(*[quoted(n) for n in names]).distinct()
    bare = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in (column, values)]
    parts = _in_parts(wanted, [*names, column], [values], rows_per_part).unionByName(groups.select("*", *bare, F.lit(0).cast("long").alias("part")))

    def cell(value: object) -> Column:
        mine = F.array_sort(F.collect_list(F.when(quoted(column) == value, quoted(values))))
        return F.array_join(mine.cast("array<string>"), ",").alias(str(value))

    return parts.groupBy(*[quoted(n) for n in names], "part").agg(*[cell(v) for v in pivot_values])


def in_one_row(
    parts: DataFrame, keys: str | Sequence[str], lists: Sequence[str] = (), arrays: Sequence[str] = (), separator: str = ","
) -> DataFrame:
    """Numbered parts put together: one row per key, with joined `lists` and JSON `arrays`, for groups that are known to fit a row.

    Parts come in their order; empty lists add nothing. What no row can hold fails here, so large groups stay in parts.
    """
    names = as_list(keys)

    def whole(name: str, start: str, end: str) -> Column:
        in_order = F.array_sort(F.collect_list(F.struct("part", quoted(name).alias("value"))))
        bare = F.transform(in_order, lambda x: x["value"].substr(F.lit(len(start) + 1), F.length(x["value"]) - len(start) - len(end)))
        return F.concat(F.lit(start), F.array_join(F.filter(bare, lambda x: x != ""), separator), F.lit(end)).alias(name)

    cells = [whole(n, "", "") for n in lists] + [whole(n, "[", "]") for n in arrays]
    return parts.groupBy(*[quoted(n) for n in names]).agg(*cells)


def distinct_values(df: DataFrame, column: str) -> list[object]:
    """The values that become columns of a pivot, in order. More than Spark's limit for pivots is an error, not a cut."""
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = [r[0] for r in df.select(quoted(column)).where(quoted(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"column {column} has more than {most} values; name those to pivot")
    return sorted(found)


def pivot_table(
    df: DataFrame,
    index: str | Sequence[str],
    column: str,
    values: str,
    aggregate: str,
    pivot_values: Sequence[object] | None = None,
) -> DataFrame:
    """Pivot with a named aggregate such as 'sum' or 'max'; a missing cell is NULL. Without `pivot_values` a job finds them."""
    pivot_values = distinct_values(df, column) if pivot_values is None else pivot_values
    pivoted = df.groupBy(*[quoted(n) for n in as_list(index)]).pivot(column, list(pivot_values))
    return pivoted.agg({values: aggregate})


def remove_duplicates(df: DataFrame) -> DataFrame:
    return df.distinct()


def column_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, as a table."""
    return df.select(quoted(column)).distinct()


def key_value_table(df: DataFrame, key: str, value: str, order_by: str) -> DataFrame:
    """Key to value, where the last row by `order_by` wins, and of equally late ones the highest value."""
    place = F.when(quoted(order_by).isNotNull(), F.struct(quoted(order_by), quoted(value)))
    return df.groupBy(quoted(key)).agg(F.max_by(quoted(value), place).alias(value))


def distinct_on(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key; which one is decided by `order_by`."""
    return group_select_first(df, keys, order_by)


def group_to_json_array(
    df: DataFrame,
    keys: str | Sequence[str],
    columns: Sequence[str],
    order_by: Sequence[str],
    rows_per_part: int,
    name: str = "items",
) -> DataFrame:
    """Each group's rows as a JSON array of objects, in order; the key of the result is (keys, `part`).

    Arrays go on in further rows after `rows_per_part` objects, counted by `part` from 0.
    """
    names = as_list(keys)
    needed = list(dict.fromkeys([*names, *order_by, *columns]))
    parts = _in_parts(df.select(*[quoted(c) for c in needed]), names, order_by, rows_per_part)
    item = F.struct(
        F.struct(*[quoted(o) for o in order_by]).alias("place"),
        F.struct(*[quoted(c) for c in columns]).alias("item"),
    )
    ordered = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"])
    return parts.groupBy(*[quoted(n) for n in names], "part").agg(
        F.to_json(ordered, {"ignoreNullFields": "false"}).alias(name)
    )


def weighted_mean(value: str | Column, weight: str | Column) -> Column:
    """Sum of value times weight over the sum of all weights. A NULL value adds nothing, but its weight counts."""
    v = quoted(value) if isinstance(value, str) else value
    w = quoted(weight) if isinstance(weight, str) else weight
    return F.try_divide(F.sum(v * w), F.sum(w))


def weighted_average(df: DataFrame, group: str, value: str, weight: str, name: str, ordered: bool = True) -> DataFrame:
    """The weighted mean per group, lowest first."""
    result = df.groupBy(quoted(group)).agg(weighted_mean(value, weight).alias(name))
    return result.orderBy(name) if ordered else result


def grouped_sum(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    return df.groupBy(quoted(group)).agg(F.sum(quoted(value)).alias(name))


def horizon_share(
    df: DataFrame,
    group: str,
    value: str,
    date_column: str,
    as_of: date | str,
    months: Sequence[int] = (12, 24, 36),
    total: str = "total",
    share: str = "share_{}m",
) -> DataFrame:
    """Per group, the total and the share of it dated within each horizon. One pass for all horizons."""
    whole = F.sum(quoted(value))

    def part(n: int) -> Column:
        return F.sum(F.when(quoted(date_column) <= horizon_end(df, date_column, as_of, n), quoted(value)))

    shares = [F.try_divide(part(n), whole).alias(share.format(n)) for n in months]
    return df.groupBy(quoted(group)).agg(whole.alias(total), *shares)


def key_bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(quoted(column)).alias("min_key"), F.max(quoted(column)).alias("max_key"))


def max_per_trimmed(df: DataFrame, group: str, value: str | Column, name: str) -> DataFrame:
    best = quoted(value) if isinstance(value, str) else value
    return df.groupBy(F.trim(quoted(group)).alias(group)).agg(F.max(best).alias(name))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and its number of rows."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in tables.items()
    ]
    result = counted[0]
    for one in counted[1:]:
        result = result.union(one)
    return result
