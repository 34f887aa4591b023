"""Change data capture. The target is `orders` as of 1997; the increment is what `lineitem` says about every order."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.queries import Tables, register
from millrace.session import cut, scratch_path
from millrace.sinks.files import write_final
from millrace.sinks.isolated import upsert_isolated
from millrace.sources.files import read_target

CUTOFF = "o_orderdate < TIMESTAMP_NTZ '1997-01-01 00:00:00'"

TARGET_SQL = (
    "tgt AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders "
    "WHERE o_orderdate < TIMESTAMP '1997-01-01')"
)
INCREMENT_SQL = (
    "inc AS (SELECT l_orderkey AS o_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS price, "
    "CASE WHEN min(l_returnflag) = 'R' THEN 'DEL' WHEN min(l_returnflag) = 'N' THEN 'INS' "
    "WHEN max(l_returnflag) = 'A' THEN NULL ELSE 'UPD' END AS op FROM lineitem GROUP BY l_orderkey)"
)


def target(t: Tables):
    return t.orders.filter(CUTOFF).select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))


def increment(t: Tables):
    # The flags as numbers: a text in an aggregation buffer would force a sort.
    flag = F.ascii("l_returnflag")
    first, last = F.min(flag), F.max(flag)
    op = (
        F.when(first == ord("R"), F.lit("DEL"))
        .when(first == ord("N"), F.lit("INS"))
        .when(last == ord("A"), F.lit(None))
        .otherwise(F.lit("UPD"))
    )
    price = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)")
    return t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(price.alias("price"), op.alias("op"))


@register(
    f"WITH {TARGET_SQL}, {INCREMENT_SQL} SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM inc WHERE op IS NOT NULL "
    "AND inc.o_orderkey = tgt.o_orderkey) UNION ALL SELECT o_orderkey, price FROM inc WHERE op IN ('UPD', 'INS')"
)
def cdc_change_indicator(t: Tables):
    return cdc.merge(target(t), increment(t), ["o_orderkey"], indicator="op")


@register(
    f"WITH {TARGET_SQL}, {INCREMENT_SQL} SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM inc "
    "WHERE inc.o_orderkey = tgt.o_orderkey) UNION ALL SELECT o_orderkey, price FROM inc"
)
def cdc_upsert_by_key(t: Tables):
    return cdc.merge(target(t), increment(t).drop("op"), ["o_orderkey"])


RANGE_INCREMENT_SQL = "(SELECT * FROM inc WHERE op = 'INS')"


@register(
    f"WITH {TARGET_SQL}, {INCREMENT_SQL} SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM {RANGE_INCREMENT_SQL} i "
    f"WHERE i.o_orderkey = tgt.o_orderkey) UNION ALL SELECT o_orderkey, price FROM {RANGE_INCREMENT_SQL}"
)
def cdc_upsert_by_range(t: Tables):
    rows = increment(t).filter("op = 'INS'").drop("op")
    return cdc.merge(target(t), rows, ["o_orderkey"], by_range=True)


@register(
    f"WITH {TARGET_SQL}, {INCREMENT_SQL}, upd AS (SELECT inc.o_orderkey, inc.price FROM inc JOIN tgt USING (o_orderkey)) "
    "SELECT * FROM (SELECT * FROM tgt EXCEPT SELECT * FROM upd) UNION ALL SELECT o_orderkey, price FROM inc"
)
def cdc_pk_literal(t: Tables):
    return cdc.merge(target(t), increment(t).drop("op"), ["o_orderkey"], literal=True)


@register(f"WITH {TARGET_SQL}, {INCREMENT_SQL} SELECT * FROM tgt UNION ALL SELECT o_orderkey, price FROM inc")
def cdc_append(t: Tables):
    return cdc.merge(target(t), increment(t).drop("op"))


@register(f"WITH {INCREMENT_SQL} SELECT o_orderkey, price FROM inc")
def cdc_first_load(t: Tables):
    return cdc.merge(None, increment(t).drop("op"), ["o_orderkey"])


@register(
    f"WITH {TARGET_SQL}, {INCREMENT_SQL} SELECT *, TIMESTAMP '2024-02-01' AS etl_insert_ts FROM (SELECT * FROM tgt "
    "WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.o_orderkey = tgt.o_orderkey) UNION ALL SELECT o_orderkey, price FROM inc)"
)
def cdc_stamped_merge(t: Tables):
    return cdc.current_version_merge(target(t), increment(t).drop("op"), ["o_orderkey"], "2024-02-01 00:00:00")


@register(
    f"WITH {TARGET_SQL}, good AS (SELECT l_orderkey AS o_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM "
    "(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, "
    "l_extendedprice DESC) rn FROM lineitem WHERE l_discount <= 0.05) WHERE rn = 1) SELECT * FROM tgt WHERE NOT EXISTS "
    "(SELECT 1 FROM good WHERE good.o_orderkey = tgt.o_orderkey) UNION ALL SELECT * FROM good"
)
def cdc_newest_valid(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
    valid = lines.filter("l_discount <= 0.05")
    newest = cdc.newest_per_key(valid, "l_orderkey", ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    rows = newest.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price")
    )
    # Read for its keys and for its rows: found once, and its keys are spread over tasks of their own.
    return cdc.upsert(target(t), cut(rows), "o_orderkey")


@register(
    f"WITH {TARGET_SQL}, {INCREMENT_SQL}, good AS (SELECT o_orderkey, price FROM inc WHERE op IS NOT NULL) "
    "SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM good WHERE good.o_orderkey = tgt.o_orderkey) "
    "UNION ALL SELECT * FROM good"
)
def upsert_with_rejects(t: Tables):
    rows = increment(t)
    labelled = target(t).withColumn("op", F.lit("UPD"))
    merged, _ = cdc.upsert_or_reject(labelled, rows, ["o_orderkey"], F.col("op").isNotNull(), all_or_nothing=False)
    return merged.drop("op")


def below_limit(batch) -> None:
    """What a constraint of the target would say: it does not tell which row is meant."""
    if any(price > 600_000 for price in batch.column("price").to_pylist() if price is not None):
        raise ValueError("a price is over the limit")


def isolated_target(t: Tables, all_or_nothing: bool):
    """The merged table after an upsert in batches, and the outcome."""
    path = scratch_path(t.spark, "upserted")
    write_final(target(t), path)
    rows = increment(t).drop("op")
    outcome = upsert_isolated(rows, path, "o_orderkey", below_limit, all_or_nothing, batch=500)
    return read_target(t.spark, path), outcome


@register(
    f"WITH {TARGET_SQL}, {INCREMENT_SQL}, good AS (SELECT o_orderkey, price FROM inc WHERE price <= 600000) SELECT *, 'table' AS place "
    "FROM tgt WHERE NOT EXISTS (SELECT 1 FROM good WHERE good.o_orderkey = tgt.o_orderkey) UNION ALL SELECT *, 'table' FROM good "
    "UNION ALL SELECT o_orderkey, price, 'ValueError: a price is over the limit' FROM inc WHERE price > 600000"
)
def isolated_upsert_keeps_good_rows(t: Tables):
    """Rows that the target refuses are found one by one inside the writing tasks; the others get in."""
    merged, outcome = isolated_target(t, all_or_nothing=False)
    found = merged.withColumn("place", F.lit("table"))
    if outcome.refused_rows is None:
        return found
    return found.unionByName(outcome.refused_rows.withColumnRenamed("error_message", "place"))


@register(
    f"WITH {TARGET_SQL}, {INCREMENT_SQL}, bad AS (SELECT count(*) AS n FROM inc WHERE price > 600000) SELECT tgt.*, n AS refused FROM tgt, bad "
    "WHERE n > 0 OR NOT EXISTS (SELECT 1 FROM inc WHERE inc.o_orderkey = tgt.o_orderkey) "
    "UNION ALL SELECT o_orderkey, price, n FROM inc, bad WHERE n = 0"
)
def isolated_upsert_all_or_nothing(t: Tables):
    """One refused row leaves the target as it was; where none is refused, all get in."""
    merged, outcome = isolated_target(t, all_or_nothing=True)
    return merged.withColumn("refused", F.lit(outcome.refused).cast("long"))


@register(
    "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
)
def duplicate_keys(t: Tables):
    return cdc.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@register(
    "SELECT CAST(d AS DATE) AS day, CASE WHEN d = DATE '2024-01-10' THEN TIMESTAMP '2024-01-10 06:30:00' "
    "ELSE CAST(d AS TIMESTAMP) END AS window_start, CASE WHEN d = DATE '2024-01-15' THEN TIMESTAMP '2024-01-15 12:00:00' "
    "ELSE CAST(d AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND END AS window_end, count(event_id) AS row_count "
    "FROM generate_series(DATE '2024-01-10', DATE '2024-01-15', INTERVAL 1 DAY) g(d) LEFT JOIN events "
    "ON CAST(ts AS DATE) = CAST(d AS DATE) AND ts BETWEEN TIMESTAMP '2024-01-10 06:30:00' AND TIMESTAMP '2024-01-15 12:00:00' "
    "GROUP BY d"
)
def daily_chunks(t: Tables):
    windows = cdc.daily_windows(t.spark, "2024-01-10 06:30:00", "2024-01-15 12:00:00")
    return cdc.rows_per_window(t.events, "ts", windows)


@register(
    "SELECT event_id, CAST(ts AS DATE) AS day FROM events "
    "WHERE ts BETWEEN TIMESTAMP '2024-01-10 06:30:00' AND TIMESTAMP '2024-01-15 12:00:00'"
)
def rows_by_window(t: Tables):
    windows = cdc.daily_windows(t.spark, "2024-01-10 06:30:00", "2024-01-15 12:00:00")
    return cdc.rows_by_window(t.events, "ts", windows).select("event_id", "day")
