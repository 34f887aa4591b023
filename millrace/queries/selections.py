"""Filters, sorts, samples and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import filters, sets, sort
from millrace.queries import Tables, register
from millrace.sources.tables import spark_sql


@register("SELECT * FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'")
def select_rows(t: Tables):
    return filters.select_rows(t.customer, "c_acctbal > 0 AND c_mktsegment = 'BUILDING'")


@register("SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment")
def sql_over_frames(t: Tables):
    return spark_sql(
        t.spark, "SELECT c_mktsegment, count(*) AS customers FROM {people} GROUP BY c_mktsegment", people=t.customer
    )


@register(
    "SELECT event_id, user_id, event_type FROM events "
    "WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00'"
)
def incremental_window(t: Tables):
    return filters.incremental_window(
        t.events, ["ts"], "2024-01-10 00:00:00", "2024-01-15 00:00:00", ["event_id", "user_id", "event_type"]
    )


@register("SELECT max(ts) AS ts FROM events WHERE event_type = 'purchase'")
def high_water_mark(t: Tables):
    return sort.latest(t.events, "ts", "event_type = 'purchase'", filters.FIRST_WATERMARK)


@register(
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01' + INTERVAL 12 MONTH"
)
def within_horizon(t: Tables):
    return filters.within_horizon(t.orders, "o_orderdate", "1998-01-01", 12).select("o_orderkey", "o_orderdate")


@register(
    "SELECT DISTINCT substring(p_name, 1, 100) AS p_name FROM part WHERE contains(p_name, 'red') OR contains(p_name, 'ring')"
)
def substring_any(t: Tables):
    return filters.contains_any(t.part, "p_name", ["red", "ring"])


@register("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def exact_lookup(t: Tables):
    padded = t.customer.withColumn("c_mktsegment", F.concat("c_mktsegment", F.lit(" ")))
    return filters.lookup_exact(padded, "c_mktsegment", "BUILDING", "c_custkey")


@register("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')")
def change_type_filter(t: Tables):
    return filters.change_types(t.orders, "o_orderstatus", ["F", "P"]).select("o_orderkey", "o_orderstatus")


@register("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey DESC")
def sort_desc(t: Tables):
    return sort.sort(t.part.select("p_partkey", "p_retailprice"), ["p_retailprice", "p_partkey"], descending=True)


@register(
    "SELECT l_orderkey, l_linenumber FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) "
    "ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber)), l_orderkey, l_linenumber LIMIT 1000"
)
def key_sample(t: Tables):
    return sort.sample_keys(t.lineitem, ["l_orderkey", "l_linenumber"], 1000)


@register(
    "SELECT l_partkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A' "
    "EXCEPT SELECT l_partkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'"
)
def complement(t: Tables):
    pairs = t.lineitem.select("l_partkey", "l_linenumber", "l_returnflag")
    return sets.complement(
        pairs.filter("l_returnflag = 'A'").drop("l_returnflag"), pairs.filter("l_returnflag = 'R'")
    )


@register(
    "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'"
)
def intersect_keys(t: Tables):
    return sets.intersect(
        t.orders.filter("o_orderstatus = 'F'").select("o_custkey"),
        t.orders.filter("o_orderstatus = 'O'").select("o_custkey"),
    )


@register("SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def union_by_name(t: Tables):
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return sets.union_by_name(people, t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")))


@register(
    "SELECT c_custkey AS id FROM customer UNION ALL SELECT s_suppkey FROM supplier UNION ALL SELECT p_partkey FROM part"
)
def union_by_position(t: Tables):
    return sets.union_by_position(
        [
            t.customer.select(F.col("c_custkey").alias("id")),
            t.supplier.select("s_suppkey"),
            t.part.select("p_partkey"),
        ]
    )


@register(
    "SELECT (SELECT count(*) FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM lineitem)) = 0 AS equal"
)
def frames_equal(t: Tables):
    even = F.coalesce(F.col("l_orderkey") % 2 == 0, F.lit(False))
    return sets.frames_equal(t.lineitem, t.lineitem.filter(even).unionByName(t.lineitem.filter(~even)))


@register(
    "SELECT count(*) AS differing_rows FROM (SELECT l_orderkey, l_linenumber FROM lineitem "
    "GROUP BY 1, 2 HAVING count(*) > 1)"
)
def frames_differ(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    return sets.difference_count(lines, lines.distinct())
