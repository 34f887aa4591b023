"""Column-level verbs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions.columns import catalog_type_name, decimal_part, drop_last
from millrace.operators import project
from millrace.operators.conform import ColumnSpec, conform, unparsed_cells
from millrace.operators.filters import select_rows
from millrace.queries import Tables, register


@register("SELECT o_orderpriority, o_orderkey FROM orders")
def get_columns(t: Tables):
    return project.get_columns(t.orders, "o_orderpriority", "o_orderkey")


@register("SELECT o_orderdate, o_orderkey, o_custkey FROM orders")
def reorder_columns(t: Tables):
    target = t.orders.select("o_orderdate", "o_orderkey", "o_custkey")
    return project.reorder_columns_to_match_target(t.orders, target)


@register(
    "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
)
def rename_cols(t: Tables):
    return project.rename(t.customer, {"c_custkey": "customer_id", "c_name": "customer_name", "absent": "x"})


@register("SELECT p_partkey, p_name, p_brand FROM part")
def cut_out(t: Tables):
    return project.cut_out(t.part, ["p_type", "p_size", "p_retailprice"])


def _customers_with_gaps(t: Tables):
    building = F.col("c_mktsegment") == "BUILDING"
    return t.customer.withColumns(
        {
            "all_null": F.lit(None).cast("string"),
            "some_null": F.when(~building, F.col("c_name")),
            "some_nan": F.when(building, F.lit(float("nan"))).otherwise(F.col("c_acctbal")),
        }
    )


@register("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def drop_null_columns(t: Tables):
    return project.drop_na_columns(_customers_with_gaps(t), "any")


@register(
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, "
    "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS some_null FROM customer"
)
def drop_all_null_columns(t: Tables):
    return project.drop_na_columns(_customers_with_gaps(t).drop("some_nan"), "all")


@register(
    "SELECT 0::BIGINT AS c_custkey, 0::BIGINT AS c_name, 0::BIGINT AS c_nationkey, 0::BIGINT AS c_acctbal, 0::BIGINT AS c_mktsegment, count(*) AS all_null, "
    "count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS some_null, "
    "count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS some_nan FROM customer"
)
def null_counts(t: Tables):
    return project.null_counts(_customers_with_gaps(t))


@register("SELECT c_custkey, c_name, 'raw' AS zone, 1 AS version_number FROM customer")
def add_fields(t: Tables):
    zoned = project.add_field(t.customer.select("c_custkey", "c_name"), "zone", "raw")
    return project.add_fields(zoned, {"version_number": 1})


@register(
    "SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS net_price FROM lineitem"
)
def computed_field(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount")
    priced = project.add_computed_field(lines, "net_price", "round(l_extendedprice * (1 - l_discount), 4)")
    return priced.drop("l_extendedprice", "l_discount")


@register("SELECT p_partkey, p_brand || '/' || p_type AS label FROM part")
def computed_by_function(t: Tables):
    def label(brand: pd.Series, kind: pd.Series) -> pd.Series:
        return brand + "/" + kind

    parts = t.part.select("p_partkey", "p_brand", "p_type")
    labelled = project.add_computed_field(parts, "label", label, ["p_brand", "p_type"], "string", vectorised=True)
    return labelled.select("p_partkey", "label")


@register("SELECT p_partkey, upper(p_name) AS p_name FROM part")
def converted_by_function(t: Tables):
    def upper(name: pd.Series) -> pd.Series:
        return name.str.upper()

    return project.conversion(t.part.select("p_partkey", "p_name"), "p_name", upper, "string", vectorised=True)


@register(
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN reverse(o_orderpriority) ELSE o_orderpriority END "
    "AS o_orderpriority FROM orders"
)
def conditional_by_function(t: Tables):
    def backwards(text: pd.Series) -> pd.Series:
        return text.str[::-1]

    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    changed = project.conditional_conversion(rows, "o_orderpriority", backwards, "o_orderstatus = 'F'", "string", vectorised=True)
    return changed.select("o_orderkey", "o_orderpriority")


@register("SELECT p_partkey FROM part WHERE p_size % 7 = 3")
def selected_by_function(t: Tables):
    def every_seventh(size: pd.Series) -> pd.Series:
        return size % 7 == 3

    return select_rows(t.part.select("p_partkey", "p_size"), every_seventh, "p_size", vectorised=True).select("p_partkey")


@register(
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN lower(o_orderpriority) ELSE o_orderpriority END "
    "AS o_orderpriority FROM orders"
)
def conditional_conversion(t: Tables):
    changed = project.conditional_conversion(t.orders, "o_orderpriority", F.lower, "o_orderstatus = 'F'")
    return changed.select("o_orderkey", "o_orderpriority")


@register(
    "SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size_str, CAST(floor(p_retailprice) AS INTEGER) AS p_price_int, "
    "CAST(p_size AS FLOAT) AS p_size_float, p_size * 10 AS p_size FROM part"
)
def cast_columns(t: Tables):
    base = t.part.select(
        "p_partkey",
        F.col("p_size").alias("p_size_str"),
        F.col("p_retailprice").alias("p_price_int"),
        F.col("p_size").alias("p_size_float"),
        "p_size",
    )
    texts = project.convert_column_to_string(base, "p_size_str")
    whole = project.convert_column_to_int(texts, "p_price_int")
    floating = project.convert_column_to_float(whole, "p_size_float")
    return project.conversion(floating, "p_size", lambda c: c * 10, "int")


@register(
    "SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18,2)) AS total_price, "
    "CAST(o_orderdate AS DATE) AS order_date, TRY_CAST(o_orderpriority AS INTEGER) AS bad_cast FROM orders"
)
def conform_schema(t: Tables):
    return conform(
        t.orders,
        [
            ColumnSpec(10, "o_orderpriority", "bad_cast", "int"),
            ColumnSpec(1, "o_orderkey", "order_id", "bigint"),
            ColumnSpec(9, "o_orderdate", "order_date", "date"),
            ColumnSpec(2, "o_totalprice", "total_price", "decimal", 18, 2),
        ],
    )


@register(
    "SELECT 'bad_cast' AS column_name, count(*) AS unparsed FROM orders "
    "UNION ALL SELECT 'order_date', count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders"
)
def unparsed_cell_counts(t: Tables):
    texts = t.orders.withColumn(
        "date_text",
        F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(F.date_format("o_orderdate", "yyyyMMdd")),
    )
    specs = [
        ColumnSpec(1, "o_orderpriority", "bad_cast", "int"),
        ColumnSpec(2, "date_text", "order_date", "date", source_datetime_format="yyyyMMdd"),
    ]
    return unparsed_cells(texts, specs)


@register(
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus "
    "WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS first_value FROM orders"
)
def first_non_sentinel(t: Tables):
    rated = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.lit("NR")).otherwise(F.col("o_orderstatus")).alias("a"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("N/A")).otherwise(F.col("o_orderpriority")).alias("b"),
        F.col("o_custkey").alias("c"),
    )
    return project.find_first_non_null_column(rated, "first_value", "a", "b", "c").select("o_orderkey", "first_value")


@register(
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand, "
    "CASE WHEN p_type <> 'ECONOMY' THEN CAST(p_retailprice AS VARCHAR) END AS price FROM part"
)
def stringify_columns(t: Tables):
    price = F.when(F.col("p_type") == "ECONOMY", F.lit(float("nan"))).otherwise(F.col("p_retailprice"))
    return project.stringify(t.part.select("p_partkey", "p_brand", price.alias("price")))


@register("SELECT p_partkey, left(p_brand, length(p_brand) - 2) AS brand_stem FROM part")
def drop_last_two(t: Tables):
    return t.part.select("p_partkey", drop_last("p_brand", 2).alias("brand_stem"))


# Types as a column inventory may name them, picked by the size of a part.
TYPE_NAMES = ["bigint", "smallint", "string", "timestamp", "datetime", "date", "varchar", "double", "decimal(10,2)"]


@register(
    "WITH v AS (SELECT p_partkey, ['bigint', 'smallint', 'string', 'timestamp', 'datetime', 'date', 'varchar', "
    "'double', 'decimal(10,2)'][CAST(p_size % 9 AS INTEGER) + 1] AS source_type FROM part) "
    "SELECT p_partkey, source_type, CASE source_type WHEN 'bigint' THEN 'Whole Number' WHEN 'smallint' THEN "
    "'Whole Number' WHEN 'string' THEN 'Text' WHEN 'timestamp' THEN 'Date Time' WHEN 'datetime' THEN 'Date Time' "
    "WHEN 'date' THEN 'Date' WHEN 'varchar' THEN 'Text' WHEN 'double' THEN 'Decimal Number' "
    "ELSE 'Decimal Number(10,2)' END AS catalog_type, "
    "CASE WHEN source_type LIKE 'decimal%' THEN '10' END AS size, "
    "CASE WHEN source_type LIKE 'decimal%' THEN '2' END AS digits FROM v"
)
def type_name_mapping(t: Tables):
    names = F.array(*[F.lit(n) for n in TYPE_NAMES])
    typed = t.part.select("p_partkey", F.get(names, (F.col("p_size") % len(TYPE_NAMES)).cast("int")).alias("source_type"))
    return typed.select(
        "p_partkey",
        "source_type",
        catalog_type_name("source_type").alias("catalog_type"),
        decimal_part("source_type", 1).alias("size"),
        decimal_part("source_type", 2).alias("digits"),
    )
