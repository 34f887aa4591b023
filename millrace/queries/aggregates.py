"""Aggregations and pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregate, sets
from millrace.queries import Tables, register

STATUSES = ["F", "O", "P"]


@register(
    "WITH n AS (SELECT o_custkey, o_orderstatus, o_orderkey, (row_number() OVER (PARTITION BY o_custkey, o_orderstatus "
    "ORDER BY o_orderkey) - 1) // 3 AS part FROM orders) "
    "SELECT o_custkey, part, coalesce(string_agg(o_orderkey, ',' ORDER BY o_orderkey) FILTER (WHERE o_orderstatus = 'F'), '') AS F, "
    "coalesce(string_agg(o_orderkey, ',' ORDER BY o_orderkey) FILTER (WHERE o_orderstatus = 'O'), '') AS O, "
    "coalesce(string_agg(o_orderkey, ',' ORDER BY o_orderkey) FILTER (WHERE o_orderstatus = 'P'), '') AS P "
    "FROM n GROUP BY o_custkey, part"
)
def pivot_concat(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey")
    return aggregate.pivot_aggregate_data(rows, "o_custkey", "o_orderstatus", "o_orderkey", rows_per_part=3, pivot_values=STATUSES)


@register(
    "SELECT o_orderpriority, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2) AS F, "
    "round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2) AS O, "
    "round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 2) AS P FROM orders GROUP BY o_orderpriority"
)
def pivot_sum(t: Tables):
    pivoted = aggregate.pivot_table(t.orders, "o_orderpriority", "o_orderstatus", "o_totalprice", "sum", STATUSES)
    return pivoted.select("o_orderpriority", *[F.round(s, 2).alias(s) for s in STATUSES])


@register("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def remove_duplicates(t: Tables):
    return aggregate.remove_duplicates(t.lineitem.select("l_orderkey", "l_linenumber"))


@register("SELECT DISTINCT l_shipdate FROM lineitem")
def column_values(t: Tables):
    return aggregate.column_values(t.lineitem, "l_shipdate")


@register("SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def key_value_last_wins(t: Tables):
    return aggregate.key_value_table(t.events, "user_id", "event_type", "event_id")


@register(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    "ORDER BY l_partkey, l_suppkey) rn FROM lineitem) WHERE rn = 1"
)
def distinct_on_keys(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return aggregate.distinct_on(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@register(
    "WITH n AS (SELECT o_custkey, o_orderkey, o_orderstatus, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) "
    "// 4 AS part FROM orders) SELECT o_custkey, part, '[' || string_agg('{\"o_orderkey\":' || o_orderkey || "
    "',\"o_orderstatus\":\"' || o_orderstatus || '\"}', ',' ORDER BY o_orderkey) || ']' AS orders_json FROM n GROUP BY o_custkey, part"
)
def group_to_json_array(t: Tables):
    return aggregate.group_to_json_array(
        t.orders, "o_custkey", ["o_orderkey", "o_orderstatus"], ["o_orderkey"], 4, "orders_json"
    )


@register(
    "SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS weighted_discount "
    "FROM lineitem GROUP BY l_returnflag"
)
def weighted_average(t: Tables):
    averaged = aggregate.weighted_average(t.lineitem, "l_returnflag", "l_discount", "l_quantity", "weighted_discount")
    return averaged.withColumn("weighted_discount", F.round("weighted_discount", 6))


@register("SELECT c_mktsegment, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY c_mktsegment")
def grouped_sum(t: Tables):
    summed = aggregate.grouped_sum(t.customer, "c_mktsegment", "c_acctbal", "balance")
    return summed.withColumn("balance", F.round("balance", 2))


@register(
    "SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total, "
    "round(sum(CASE WHEN o_orderdate <= TIMESTAMP '1999-01-01' THEN o_totalprice END) / sum(o_totalprice), 6) AS share_12m, "
    "round(sum(CASE WHEN o_orderdate <= TIMESTAMP '2000-01-01' THEN o_totalprice END) / sum(o_totalprice), 6) AS share_24m, "
    "round(sum(CASE WHEN o_orderdate <= TIMESTAMP '2001-01-01' THEN o_totalprice END) / sum(o_totalprice), 6) AS share_36m "
    "FROM orders GROUP BY o_orderpriority"
)
def horizon_share(t: Tables):
    shares = aggregate.horizon_share(t.orders, "o_orderpriority", "o_totalprice", "o_orderdate", "1998-01-01")
    rounded = {c: F.round(c, 6) for c in shares.columns if c.startswith("share")}
    return shares.withColumns({"total": F.round("total", 2), **rounded})


@register(
    "SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, a.orders_f, b.orders_urgent FROM (SELECT o_custkey, "
    "count(*) orders_f FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a FULL JOIN (SELECT o_custkey, count(*) "
    "orders_urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) b ON a.o_custkey = b.o_custkey"
)
def grouped_report(t: Tables):
    def counted(condition: str, name: str):
        return t.orders.filter(condition).groupBy("o_custkey").agg(F.count(F.lit(1)).alias(name))

    return sets.column_concat(
        [counted("o_orderstatus = 'F'", "orders_f"), counted("o_orderpriority = '1-URGENT'", "orders_urgent")],
        ["o_custkey"],
    )


@register("SELECT min(l_orderkey) AS min_key, max(l_orderkey) AS max_key FROM lineitem")
def key_bounds(t: Tables):
    return aggregate.key_bounds(t.lineitem, "l_orderkey")


@register("SELECT trim(p_brand) AS p_brand, max(p_size) AS latest FROM part GROUP BY trim(p_brand)")
def max_per_trimmed(t: Tables):
    padded = t.part.withColumn("p_brand", F.concat(F.lit(" "), "p_brand", F.lit("  ")))
    return aggregate.max_per_trimmed(padded, "p_brand", "p_size", "latest")


@register(
    "SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem"
)
def row_counts(t: Tables):
    return aggregate.row_counts({"orders": t.orders, "lineitem": t.lineitem})
