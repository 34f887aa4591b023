"""Joins, lookups, row numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import joins, windows
from millrace.queries import Tables, register

EARLY = "o_orderdate < TIMESTAMP_NTZ '1995-06-01 00:00:00'"


@register("SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def inner_join(t: Tables):
    return joins.join(
        t.orders.select("o_orderkey", "o_custkey"),
        t.customer.select("c_custkey", "c_name"),
        left_keys="o_custkey",
        right_keys="c_custkey",
    )


@register(
    "SELECT l_orderkey, count(*) AS lines_per_order_line FROM lineitem a JOIN (SELECT DISTINCT l_orderkey, l_linenumber "
    "FROM lineitem) b USING (l_orderkey, l_linenumber) GROUP BY l_orderkey"
)
def inner_join_two_keys(t: Tables):
    keys = ["l_orderkey", "l_linenumber"]
    lines = t.lineitem.select(*keys)
    return joins.inner_join(lines, lines.distinct(), keys).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines_per_order_line")
    )


@register(
    "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders "
    "WHERE o_orderdate < TIMESTAMP '1995-06-01') o ON c_custkey = o_custkey"
)
def left_join(t: Tables):
    early = t.orders.filter(EARLY).select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return joins.left_join(t.customer.select("c_custkey"), early, "c_custkey", hot_right_keys=True)


@register(
    "SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders LEFT JOIN (SELECT * FROM customer "
    "WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey"
)
def left_join_other_names(t: Tables):
    building = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")
    return joins.left_join_different_key_names(
        t.orders.select("o_orderkey", "o_custkey"), building, "o_custkey", "c_custkey"
    )


@register(
    "SELECT coalesce(a.k, b.k) AS k, a.c_name, b.p_name FROM (SELECT c_custkey AS k, c_name FROM customer) a "
    "FULL JOIN (SELECT p_partkey * 2 AS k, p_name FROM part) b ON a.k = b.k"
)
def outer_join(t: Tables):
    people = t.customer.select(F.col("c_custkey").alias("k"), "c_name")
    parts = t.part.select((F.col("p_partkey") * 2).alias("k"), "p_name")
    return joins.outer_join(people, parts, "k")


@register(
    "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderdate, o_orderkey) rn FROM orders) o ON c_custkey = o_custkey AND rn = 1"
)
def lookup_join(t: Tables):
    return joins.lookup_join(
        t.customer.select("c_custkey"),
        t.orders.select("o_custkey", "o_orderkey", "o_orderdate"),
        left_keys="c_custkey",
        right_keys="o_custkey",
        order_by=["o_orderdate", "o_orderkey"],
    ).select("c_custkey", "o_orderkey")


@register(
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey "
    "AND o_orderdate < TIMESTAMP '1995-06-01')"
)
def anti_join(t: Tables):
    return joins.anti_join(
        t.customer.select("c_custkey", "c_name"),
        t.orders.filter(EARLY),
        left_keys="c_custkey",
        right_keys="o_custkey",
    )


@register(
    "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey "
    "AND o_orderdate < TIMESTAMP '1995-06-01')"
)
def semi_join(t: Tables):
    return joins.semi_join(
        t.customer.select("c_custkey", "c_name"),
        t.orders.filter(EARLY),
        left_keys="c_custkey",
        right_keys="o_custkey",
    )


@register(
    "WITH dim AS (SELECT p_brand, p_type, row_number() OVER (ORDER BY p_brand, p_type) AS sk "
    "FROM (SELECT DISTINCT p_brand, p_type FROM part)) "
    "SELECT p_partkey, sk AS brand_type_fk FROM part JOIN dim USING (p_brand, p_type)"
)
def surrogate_key_lookup(t: Tables):
    parts = t.part.select("p_partkey", "p_brand", "p_type")
    natural = parts.select("p_brand", "p_type").distinct()
    dimension = windows.surrogate_keys(natural, ["p_brand", "p_type"], "sk")
    return joins.surrogate_key_lookup(
        parts, dimension, ["p_brand", "p_type"], "sk", "brand_type_fk", ["p_brand", "p_type"], "inner"
    )


@register(
    "WITH old AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS id FROM supplier) "
    "SELECT (SELECT max(id) FROM old) + row_number() OVER (ORDER BY c_custkey) AS id, c_custkey FROM customer"
)
def surrogate_keys_continued(t: Tables):
    old = windows.surrogate_keys(t.supplier.select("s_suppkey"), "s_suppkey", "id")
    return windows.surrogate_keys(t.customer.select("c_custkey"), "c_custkey", "id", old)


@register(
    "SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_index FROM orders"
)
def row_index(t: Tables):
    return windows.row_index(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])


@register(
    "SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS row_number FROM events"
)
def number_in_hot_groups(t: Tables):
    rows = t.events.select("event_id", "event_type", "ts")
    return windows.number_within_groups(rows, "event_type", ["ts", "event_id"]).drop("ts")


@register(
    "WITH a AS (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) i FROM supplier), "
    "b AS (SELECT p_name, row_number() OVER (ORDER BY p_partkey DESC) i FROM part) SELECT s_name, p_name FROM a JOIN b USING (i)"
)
def positional_zip(t: Tables):
    zipped = windows.positional_zip(
        t.supplier.select("s_suppkey", "s_name"),
        t.part.select("p_partkey", "p_name"),
        ["s_suppkey"],
        [F.col("p_partkey").desc()],
    )
    return zipped.select("s_name", "p_name")


@register(
    "SELECT c_custkey, n_name AS country, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey"
)
def enrich_lookup(t: Tables):
    customers = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    enriched, _ = joins.enrich(
        customers,
        [
            (t.nation, "n_nationkey", {"n_name": "country", "n_regionkey": "r_regionkey"}),
            (t.region, "r_regionkey", {"r_name": "region"}),
        ],
    )
    return enriched.select("c_custkey", "country", "region")


@register(
    "SELECT DISTINCT 'o_custkey' AS lookup, CAST(o_custkey AS VARCHAR) AS key FROM orders "
    "WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"
)
def unmapped_keys(t: Tables):
    building = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    _, unmapped = joins.enrich(
        t.orders.select("o_orderkey", "o_custkey"), [(building, "o_custkey", {"c_name": "name"})], required=True
    )
    return unmapped


@register(
    "SELECT o_custkey, o_orderkey FROM orders a WHERE o_orderdate = "
    "(SELECT max(b.o_orderdate) FROM orders b WHERE b.o_custkey = a.o_custkey)"
)
def latest_version(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return windows.latest_rows(rows, "o_custkey", "o_orderdate").select("o_custkey", "o_orderkey")


@register(
    "SELECT event_type, event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type "
    "ORDER BY ts, event_id) rn FROM events) WHERE rn = 1"
)
def group_select_first(t: Tables):
    rows = t.events.select("event_type", "event_id", "user_id", "ts")
    return windows.group_select_first(rows, "event_type", ["ts", "event_id"]).drop("ts")
