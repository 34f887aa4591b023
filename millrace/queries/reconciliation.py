"""Reconciliation: `customer` against a copy with some names and balances changed and some rows missing."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import reconcile
from millrace.queries import Tables, register

COPY_SQL = (
    "b AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) || '*' ELSE c_name END AS c_name, "
    "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_nationkey <> 7)"
)
SOURCE_SQL = "a AS (SELECT c_custkey, c_name, c_acctbal FROM customer)"


def source(t: Tables):
    return t.customer.select("c_custkey", "c_name", "c_acctbal")


def copy(t: Tables):
    return t.customer.filter("c_nationkey <> 7").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.upper("c_name"), F.lit("*")))
        .otherwise(F.col("c_name"))
        .alias("c_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
    )


@register(
    f"WITH {SOURCE_SQL}, {COPY_SQL} SELECT c_custkey, b.c_name, b.c_acctbal, concat_ws(',', CASE WHEN a.c_name IS DISTINCT FROM "
    "b.c_name THEN 'c_name' END, CASE WHEN a.c_acctbal IS DISTINCT FROM b.c_acctbal THEN 'c_acctbal' END) AS column_names "
    "FROM a JOIN b USING (c_custkey) WHERE a.c_name IS DISTINCT FROM b.c_name OR a.c_acctbal IS DISTINCT FROM b.c_acctbal"
)
def cell_mismatch(t: Tables):
    found = reconcile.cell_mismatches(source(t), copy(t), "c_custkey")
    return found.withColumn("column_names", F.array_join("column_names", ","))


@register(
    f"WITH {SOURCE_SQL}, {COPY_SQL}, k AS (SELECT DISTINCT c_custkey FROM a ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 500) "
    "SELECT c_custkey, concat_ws(',', CASE WHEN a.c_name IS DISTINCT FROM b.c_name THEN 'c_name' END, "
    "CASE WHEN a.c_acctbal IS DISTINCT FROM b.c_acctbal THEN 'c_acctbal' END) AS column_names FROM k JOIN a USING (c_custkey) JOIN b USING (c_custkey) "
    "WHERE a.c_name IS DISTINCT FROM b.c_name OR a.c_acctbal IS DISTINCT FROM b.c_acctbal"
)
def sampled_mismatch(t: Tables):
    found = reconcile.sampled_mismatches(source(t), copy(t), "c_custkey", 500)
    return found.select("c_custkey", F.array_join("column_names", ",").alias("column_names"))


@register(
    f"WITH {SOURCE_SQL}, {COPY_SQL} SELECT *, 'source' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) "
    "UNION ALL SELECT *, 'target' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"
)
def two_way_difference(t: Tables):
    return reconcile.two_way_difference(source(t), copy(t))


@register(
    "SELECT c_custkey, CASE WHEN c_nationkey <> 7 THEN 'both' ELSE 'source' END AS found_in FROM customer"
)
def key_presence(t: Tables):
    return reconcile.key_presence(source(t), copy(t), "c_custkey")


@register(
    "SELECT c_custkey, sha256(concat_ws(chr(31), CAST(c_custkey AS VARCHAR), c_name, c_mktsegment)) AS full_key FROM customer"
)
def full_row_key(t: Tables):
    return reconcile.full_row_key(t.customer, ["c_custkey", "c_name", "c_mktsegment"]).select("c_custkey", "full_key")


@register(
    f"WITH {SOURCE_SQL}, {COPY_SQL}, d AS (SELECT * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL "
    "SELECT * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) SELECT count(*) AS differing_rows, count(*) = 0 AS no_mismatch FROM d"
)
def no_mismatch(t: Tables):
    return reconcile.no_mismatch(source(t), copy(t))


@register(
    "SELECT p_partkey, list_extract(['int', 'varchar', 'timestamp', 'bigint'], CAST(p_size % 4 AS INTEGER) + 1) AS source_datatype, "
    "'string' AS target_datatype, CASE p_size % 4 WHEN 0 THEN 'number' WHEN 1 THEN 'string' ELSE 'date' END AS source_family, "
    "'string' AS target_family, p_size % 4 = 1 AS matching FROM part"
)
def metadata_check(t: Tables):
    names = F.array(*[F.lit(n) for n in ["int", "varchar", "timestamp", "bigint"]])
    inventory = t.part.select(
        F.col("p_partkey").alias("source_column_name"),
        F.col("p_name").alias("target_column_name"),
        F.get(names, F.col("p_size") % 4).alias("source_datatype"),
        F.lit("string").alias("target_datatype"),
    )
    checked = reconcile.metadata_check(inventory)
    return checked.withColumnRenamed("source_column_name", "p_partkey").drop("target_column_name")
