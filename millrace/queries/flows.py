"""Whole flows: tables of the catalog, runs and their logs, sources that are split or looked up first."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from millrace.operators import aggregate
from millrace.operators.conform import ColumnSpec
from millrace.operators.filters import windowed_query
from millrace.operators.joins import inner_join
from millrace.operators.project import convert_column_to_int, rename
from millrace.operators.quality import Rule
from millrace.operators.windows import add_column
from millrace.plans import catalog, lineage, methodology, pipelines
from millrace.plans.quality_run import run_rules, write_run
from millrace.queries import Tables, register
from millrace.queries.files import order_runs
from millrace.queries.quality import ORDER_RULES, RUN
from millrace.session import scratch_path
from millrace.sinks import commits, tables
from millrace.sinks import files as sinks
from millrace.sources import files as sources
from millrace.sources import jdbc
from millrace.sources.tables import catalog_table, spark_sql

# --- tables of the catalog

TABLE_SPECS = [
    ColumnSpec(2, "price", "price", "decimal", 18, 2),
    ColumnSpec(1, "order_id", "order_id", "bigint"),
    ColumnSpec(3, "priority", "priority", "string", 20),
    ColumnSpec(4, "status", "status", "string"),
]
ORDER_TABLE_SQL = (
    "SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderpriority AS priority, o_orderstatus AS status FROM orders"
)


def order_rows(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
    )


def table_name() -> str:
    return f"millrace_{uuid.uuid4().hex}"


def stored_orders(t: Tables) -> str:
    path = scratch_path(t.spark, "external")
    order_rows(t).write.partitionBy("status").parquet(path)
    return path


@register(ORDER_TABLE_SQL)
def table_from_specs(t: Tables):
    """An external table defined by column specs over files that are there already; its partitions are found."""
    name, path = table_name(), stored_orders(t)
    tables.create_table_from_specs(t.spark, name, TABLE_SPECS, path, "status")
    tables.discover_partitions(t.spark, name)
    return catalog_table(t.spark, name)


@register(ORDER_TABLE_SQL)
def table_like_frame(t: Tables):
    name, path = table_name(), stored_orders(t)
    tables.create_table_like(order_rows(t), name, path, "status")
    tables.discover_partitions(t.spark, name)
    return catalog_table(t.spark, name)


@register("SELECT 'before' AS moment, CAST(NULL AS VARCHAR) AS status, 0 AS n UNION ALL SELECT 'after', o_orderstatus, count(*) FROM orders GROUP BY 2")
def partitions_discovered(t: Tables):
    """Files that are added behind the table's back are seen once their partitions are discovered."""
    name, path = table_name(), scratch_path(t.spark, "external")
    tables.create_table_from_specs(t.spark, name, TABLE_SPECS, path, "status")
    order_rows(t).write.partitionBy("status").parquet(path)
    before = t.spark.createDataFrame([("before", None, catalog_table(t.spark, name).count())], "moment string, status string, n long")
    tables.discover_partitions(t.spark, name)
    after = catalog_table(t.spark, name).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return before.unionByName(after.withColumn("moment", F.lit("after")))


@register("SELECT o_orderpriority AS priority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def view_over_table(t: Tables):
    name, view = table_name(), table_name()
    tables.create_table_from_specs(t.spark, name, TABLE_SPECS, stored_orders(t), "status")
    tables.discover_partitions(t.spark, name)
    tables.create_view(t.spark, view, f"SELECT priority, count(*) AS n FROM {name} WHERE status = 'F' GROUP BY priority")
    return catalog_table(t.spark, view)


# --- files


@register("SELECT p_brand AS app_name, p_partkey, p_name FROM part")
def configs_per_app(t: Tables):
    path = scratch_path(t.spark, "configs")
    configs = t.part.select(F.col("p_brand").alias("app_name"), "p_partkey", "p_name")
    sinks.write_config_per_app(configs, path)
    return sources.read_json(t.spark, path, configs.schema, array_file=False)


@register("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0 UNION ALL SELECT s_suppkey, s_name FROM supplier")
def frames_written(t: Tables):
    """A path is written, written over, and added to."""
    path = scratch_path(t.spark, "frames")
    sinks.write_frame(t.customer.select("c_custkey", "c_name"), path)
    sinks.write_frame(t.customer.filter("c_acctbal > 0").select("c_custkey", "c_name"), path)
    sinks.write_frame(t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name")), path, mode="append")
    return t.spark.read.parquet(path)


@register("SELECT max(CAST(ts AS DATE)) AS last_date FROM events")
def last_file_date(t: Tables):
    """Files named by the days of the events; the number of days is small, whatever the number of events."""
    folder = scratch_path(t.spark, "dated")
    days = t.events.select(F.date_format("ts", "yyyyMMdd").alias("d")).distinct().toLocalIterator()
    for r in days:
        commits.write_text(t.spark, f"{folder}/in/feed_{r['d']}_reconciled.csv", r["d"])
    return sources.latest_file_date(t.spark, f"{folder}/in")


@register(
    "SELECT part, count(*) AS n, min(o_orderpriority) AS low, max(o_orderpriority) AS high FROM (SELECT *, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS part FROM orders) "
    "GROUP BY part"
)
def ranges_of_texts(t: Tables):
    """The ranges that a database would be asked for, by a key that is no number, with the table itself in its place."""
    lows = spark_sql(t.spark, jdbc.bounds_by_rank_query("SELECT * FROM {orders}", "o_orderpriority", 40), orders=t.orders)
    found = jdbc.range_predicates("o_orderpriority", [r["low"] for r in lows.collect()])
    ranges = [t.orders.filter(p).select(F.lit(k).cast("long").alias("part"), "o_orderpriority") for k, p in enumerate(found)]
    every = ranges[0]
    for other in ranges[1:]:
        every = every.unionByName(other)
    return every.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderpriority").alias("low"), F.max("o_orderpriority").alias("high"))


@register("SELECT o_orderkey, CAST(1 AS BIGINT) AS met FROM orders")
def ranges_are_disjoint_and_complete(t: Tables):
    """How many of a key's ranges each row meets, NULL and repeated keys included."""
    keyed = t.orders.withColumn("k", F.when(F.col("o_orderkey") % 10 > 0, F.col("o_orderdate")))
    lows = spark_sql(t.spark, jdbc.bounds_by_rank_query("SELECT * FROM {keyed}", "k", 8), keyed=keyed)
    conditions = [F.expr(p) for p in jdbc.range_predicates("k", [r["low"] for r in lows.collect()])]
    met = sum((F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0) for c in conditions), F.lit(0))
    return keyed.select("o_orderkey", met.cast("long").alias("met"))


@register(
    "SELECT 'window' AS part, o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' "
    "UNION ALL SELECT 'first', o_orderkey FROM orders"
)
def templated_query(t: Tables):
    """A user's query with places for both ends of the window; before any earlier run the full load's query stands for it."""
    template = "SELECT o_orderkey FROM {orders} WHERE o_orderdate >= timestamp_ntz '{}' AND o_orderdate < timestamp_ntz '{}'"
    parts = []
    for name, since in (("window", "1996-01-01 00:00:00"), ("first", None)):
        text = windowed_query(template, since, "1997-01-01 00:00:00", "SELECT o_orderkey FROM {orders}")
        parts.append(spark_sql(t.spark, text, orders=t.orders).select(F.lit(name).alias("part"), "o_orderkey"))
    return parts[0].unionByName(parts[1])


# --- columns and rows


@register("SELECT s_suppkey, 'label ' || row_number() OVER (ORDER BY s_suppkey DESC) AS label FROM supplier")
def column_of_values(t: Tables):
    """A list of values, one for each row, in an order."""
    values = [f"label {k}" for k in range(1, t.supplier.count() + 1)]
    return add_column(t.supplier.select("s_suppkey"), "label", values, "string", [F.col("s_suppkey").desc()])


@register(
    "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(trunc(l_extendedprice) AS INTEGER) "
    "WHEN 2 THEN -l_linenumber ELSE CAST(trunc(l_quantity) AS INTEGER) END AS n FROM lineitem"
)
def whole_parts(t: Tables):
    """Texts as whole numbers: decimals lose their fraction, what is no plain number becomes NULL."""
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    kind = F.col("l_linenumber") % 4
    text = (
        F.when(kind == 0, F.concat(price, F.lit("e1")))
        .when(kind == 1, price)
        .when(kind == 2, F.format_string("-%d.", "l_linenumber"))
        .otherwise(F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" ")))
    )
    return convert_column_to_int(t.lineitem.select("l_orderkey", "l_linenumber", text.alias("n")), "n")


@register(
    "SELECT l_orderkey, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber) FILTER (WHERE l_returnflag = 'R') AS \"R\", "
    "string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber) FILTER (WHERE l_returnflag = 'N') AS \"N\" FROM lineitem GROUP BY 1"
)
def pivot_in_one_row(t: Tables):
    """Pivoted lists whose parts are put together, as orders have few lines."""
    parts = aggregate.pivot_aggregate_data(t.lineitem, "l_orderkey", "l_returnflag", "l_linenumber", 2, ["R", "N"])
    whole = aggregate.in_one_row(parts, "l_orderkey", ["R", "N"])
    return whole.select("l_orderkey", *[F.nullif(F.col(c), F.lit("")).alias(c) for c in ("R", "N")])


@register(
    "SELECT l_orderkey, '[' || string_agg('{\"l_linenumber\":' || l_linenumber || '}', ',' ORDER BY l_linenumber) || ']' AS items FROM "
    "(SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY 1"
)
def json_array_in_one_row(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber").distinct()
    parts = aggregate.group_to_json_array(lines, "l_orderkey", ["l_linenumber"], ["l_linenumber"], 2)
    return aggregate.in_one_row(parts, "l_orderkey", arrays=["items"])


@register("SELECT c_custkey, TIMESTAMP '2024-02-01' AS modified_dtm, true AS by_current_user FROM customer")
def stamped_by_user(t: Tables):
    """Rows stamped without a named user carry Spark's own."""
    rows = methodology.stamped(t.customer.select("c_custkey"), "2024-02-01 00:00:00", None)
    mine = (F.col("modified_user_id") == F.current_user()) & (F.length("modified_user_id") > 0)
    return rows.select("c_custkey", "modified_dtm", mine.alias("by_current_user"))


# --- runs


@register(ORDER_TABLE_SQL.replace(", o_orderpriority AS priority, o_orderstatus AS status", "") + " WHERE o_orderstatus = 'O'")
def full_load_replaces(t: Tables):
    """A full load takes no window and leaves nothing of the load before."""
    spec, run = order_runs(t, primary_key=("order_id",), cdc_timestamp_columns=("o_orderdate",), load="full")
    run(t.orders.filter("o_orderstatus <> 'O'"))
    run(t.orders.filter("o_orderstatus = 'O'"), since="2100-01-01 00:00:00", until="2100-01-02 00:00:00")
    return sources.read_target(t.spark, spec.target_path)


@register(
    "SELECT 0 AS landing_count, 0 AS final_count, 'SUCCESS' AS job_status, count(*) AS stored FROM orders UNION ALL "
    "SELECT count(*), count(*), 'SUCCESS', count(*) FROM orders"
)
def empty_increment(t: Tables):
    """A second run over a window without changes writes nothing, and says so."""
    spec, run = order_runs(t, primary_key=("order_id",), cdc_timestamp_columns=("o_orderdate",))
    outcomes = []
    for since in ("1900-01-01 00:00:00", "2100-01-01 00:00:00"):
        row = run(t.orders, since=since, until="2100-01-02 00:00:00")
        stored = sources.read_target(t.spark, spec.target_path).count()
        outcomes.append((row["landing_count"], row["final_count"], row["job_status"], stored))
    return t.spark.createDataFrame(outcomes, "landing_count long, final_count long, job_status string, stored long")


@register(
    "SELECT 'orders' AS pipeline_id, execution_id, 'SUCCESS' AS job_status, n AS final_count FROM (SELECT 'one' AS execution_id, count(*) AS n "
    "FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT 'two', count(*) FROM orders)"
)
def status_is_stored(t: Tables):
    """Each run reads its window's start from the status table that the run before has stored; a repeated run has one row."""
    spec, run = order_runs(t, primary_key=("order_id",), cdc_timestamp_columns=("o_orderdate",))
    path = scratch_path(t.spark, "status")
    loads = (("one", t.orders.filter("o_orderstatus <> 'F'"), None), ("two", t.orders, "1900-01-01 00:00:00"))
    for execution, source, since in (*loads, loads[1]):
        row = run(source, since=since, until="2100-01-01 00:00:00", execution_id=execution, status=pipelines.stored_status(t.spark, path))
        pipelines.store_status(path, t.spark.createDataFrame([row], pipelines.JOB_STATUS))
    return pipelines.stored_status(t.spark, path).select("pipeline_id", "execution_id", "job_status", "final_count")


BROKEN_RULES = [
    replace(ORDER_RULES[0], rule_id="r_kind", kind="guess"),
    Rule("r_values", "between", ("o_totalprice",), ("o_orderkey",), (1,), table_name="orders"),
    Rule("r_column", "not_null", ("absent",), ("o_orderkey",), table_name="orders", zone="other"),
]


@register(
    "SELECT 'r_in_set' AS rule_id, 'SUCCESS' AS execution_status, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS failing FROM orders "
    "UNION ALL SELECT 'r_between', 'SUCCESS', count(*) FILTER (WHERE o_totalprice NOT BETWEEN 1000 AND 300000) FROM orders "
    "UNION ALL SELECT 'r_not_null', 'SUCCESS', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders "
    "UNION ALL SELECT 'r_column', 'FAILED', NULL"
)
def rule_log(t: Tables):
    """The log and the summary of a run: a rule over a column that is not there is logged and leaves the others alone."""
    path = scratch_path(t.spark, "errors")
    summary, log = write_run(t.spark, [*ORDER_RULES, BROKEN_RULES[2]], {"orders": t.orders}, RUN, path)
    return log.join(summary, "rule_id", "left").select("rule_id", "execution_status", "failing")


@register(
    "SELECT 'r_kind' AS rule_id, 'FAILED' AS execution_status, 'r_kind: unknown kind guess' AS error_message, count(*) AS checked FROM orders "
    "UNION ALL SELECT 'r_values', 'FAILED', 'r_values: between has too few values', count(*) FROM orders"
)
def rule_problems_logged(t: Tables):
    """Rules that are defined wrongly are told before anything runs, with how many rows the others checked."""
    _, summary, log = run_rules(t.spark, [*ORDER_RULES, *BROKEN_RULES[:2]], {"orders": t.orders}, RUN)
    checked = summary.agg(F.max("checked")).first()[0]
    return log.select("rule_id", "execution_status", "error_message", F.lit(checked).cast("long").alias("checked"))


@register(
    "SELECT 'inner_join' AS verb, 'customers' AS target, 'orders,customer' AS sources, 4 AS n_columns, (SELECT count(*) FROM orders JOIN customer ON "
    "o_custkey = c_custkey) AS n_rows UNION ALL SELECT 'rename', 'named', 'customers', 4, (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) "
    "UNION ALL SELECT 'Final', 'CUSTOMER_ORDERS', 'named', 4, (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey)"
)
def lineage_records(t: Tables):
    """A script of two verbs that is recorded as it runs."""
    log = lineage.LineageLog(t.spark, "script", "esg")
    orders = t.orders.select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("custkey"))
    customers = t.customer.select(F.col("c_custkey").alias("custkey"), "c_name")
    joined = log.apply(inner_join, "customers", {"orders": orders, "customer": customers}, "custkey", record={"key_cols": ["custkey"]})
    named = log.apply(rename, "named", {"customers": joined}, {"c_name": "name"})
    log.finish(named, "named", "CUSTOMER_ORDERS", "/final/customer_orders")
    return log.to_frame().select(
        F.col("transformation_func_nm").alias("verb"), F.col("target_tables").alias("target"), F.array_join("source_tables", ",").alias("sources"),
        F.size("final_df_cols").alias("n_columns"), F.lit(named.count()).cast("long").alias("n_rows"),
    )


@register(
    "SELECT dataset, first_column, n, n_rows FROM (SELECT 'orders' AS dataset, 'o_orderkey' AS first_column, 'bigint' AS kind, "
    "(SELECT count(*) FROM orders) AS n_rows, (SELECT count(*) FROM (DESCRIBE orders)) AS n UNION ALL SELECT 'customer', 'c_custkey', 'bigint', "
    "(SELECT count(*) FROM customer), (SELECT count(*) FROM (DESCRIBE customer)))"
)
def dataset_column_lists(t: Tables):
    """Column lists of datasets as JSON, with how many rows each dataset has."""
    datasets = {"orders": t.orders, "customer": t.customer}
    listed = catalog.dataset_columns(datasets)
    pairs = F.from_json("columns", "array<struct<column_name: string, column_type: string>>")
    counts = aggregate.row_counts(datasets).toDF("dataset", "n_rows")
    return listed.join(counts, "dataset").select(
        "dataset", pairs[0]["column_name"].alias("first_column"), F.size(pairs).cast("long").alias("n"), "n_rows"
    )


@register("SELECT CAST(i AS VARCHAR) AS pipeline_id FROM (VALUES ('absent'), ('Brand#none')) v(i) WHERE i NOT IN (SELECT p_brand FROM part)")
def pipeline_selection_missing(t: Tables):
    """Pipelines that were asked for and are not in the inventory."""
    inventory = t.part.select(F.col("p_brand").alias("pipeline_id"), "p_partkey")
    _, missing = pipelines.select_pipelines(inventory, ["Brand#2", "absent", "Brand#none"])
    return missing
