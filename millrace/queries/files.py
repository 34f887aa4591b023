"""Round trips through files: write a whole table in a format, read it back, conform it."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.conform import ColumnSpec, conform
from millrace.plans.ingest import run_pipeline
from millrace.plans.pipelines import SUCCESS, PipelineSpec
from millrace.plans.runs import outcomes, run_pipelines
from millrace.queries import Tables, register
from millrace.queries.quality import ORDER_RULES, RUN
from millrace.operators.quality import error_rows
from millrace.session import scratch_path
from millrace.sinks import commits
from millrace.sinks import files as sinks
from millrace.sources import files as sources

ORDER_SPECS = [
    ColumnSpec(1, "o_orderkey", "order_id", "bigint"),
    ColumnSpec(2, "o_custkey", "customer_id", "bigint"),
    ColumnSpec(3, "o_totalprice", "price", "decimal", 18, 2),
    ColumnSpec(4, "o_orderdate", "ordered", "date", source_datetime_format="yyyyMMdd"),
    ColumnSpec(5, "o_orderpriority", "priority", "varchar"),
]
ORDERS_SQL = (
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS price, "
    "CAST(o_orderdate AS DATE) AS ordered, o_orderpriority AS priority FROM orders"
)


def order_texts(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("o_orderdate"),
        "o_orderpriority",
    )


@register(ORDERS_SQL)
def delimited_round_trip(t: Tables):
    path = scratch_path(t.spark, "orders") + ".csv"
    sinks.write_csv_feed(order_texts(t), path)
    return conform(sources.read_source(t.spark, path, ORDER_SPECS), ORDER_SPECS)


@register(ORDERS_SQL)
def headerless_round_trip(t: Tables):
    path = scratch_path(t.spark, "orders") + ".pip"
    order_texts(t).write.option("sep", "|").csv(path)
    return conform(sources.read_source(t.spark, path, ORDER_SPECS), ORDER_SPECS)


def odd_shapes(t: Tables, path: str):
    """Orders in three files' shapes below one path: cells with the delimiter in quotes, columns in another order, and a column
    that nobody declared."""
    noted = order_texts(t).withColumn("o_orderpriority", F.concat("o_orderpriority", F.lit(", \"as said\"")))
    shapes = [ORDER_COLUMNS, ORDER_COLUMNS[::-1], [*ORDER_COLUMNS[:2], "extra", *ORDER_COLUMNS[2:]]]
    for k, columns in enumerate(shapes):
        part = noted.filter(F.col("o_orderkey").cast("long") % 3 == k).withColumn("extra", F.lit("a,b"))
        part.select(*columns).write.csv(f"{path}/shape{k}.csv", header=True)


ORDER_COLUMNS = [s.source_column_name for s in ORDER_SPECS]


@register(ORDERS_SQL.replace("o_orderpriority AS", "o_orderpriority || ', \"as said\"' AS"))
def detected_round_trip(t: Tables):
    path = scratch_path(t.spark, "orders")
    odd_shapes(t, path)
    return conform(sources.read_source(t.spark, f"{path}/*.csv", ORDER_SPECS), ORDER_SPECS)


@register(ORDERS_SQL)
def mixed_json_round_trip(t: Tables):
    """A folder with files of one record a line, and files that are one array over several lines."""
    path = scratch_path(t.spark, "orders")
    texts = order_texts(t)
    few = F.col("o_orderkey").cast("long") % 100 == 0
    texts.filter(~few).write.json(f"{path}/lines.json")
    block = F.floor(F.col("o_orderkey").cast("long") / 50_000)  # 500 records an array at most
    items = F.array_join(F.collect_list(F.to_json(F.struct(*texts.columns))), ",\n")
    arrays = texts.filter(few).groupBy(block).agg(F.concat(F.lit("[\n"), items, F.lit("\n]")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{path}/array.json")
    return conform(sources.read_source(t.spark, f"{path}/*.json", schema=texts.schema), ORDER_SPECS)


@register(ORDERS_SQL)
def json_round_trip(t: Tables):
    path = scratch_path(t.spark, "orders") + ".json"
    texts = order_texts(t)
    texts.write.json(path)
    return conform(sources.read_source(t.spark, path, schema=texts.schema), ORDER_SPECS)


@register(ORDERS_SQL)
def xml_round_trip(t: Tables):
    path = scratch_path(t.spark, "orders") + ".xml"
    texts = order_texts(t)
    texts.write.format("xml").option("rootTag", "orders").option("rowTag", "order").save(path)
    return conform(sources.read_source(t.spark, path, schema=texts.schema), ORDER_SPECS)


@register(
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'"
)
def staged_self_overwrite(t: Tables):
    path = scratch_path(t.spark, "final")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.write_table(rows, path, "final")
    current = sources.read_target(t.spark, path)
    changed = current.filter("o_orderstatus <> 'P'").union(current.filter("o_orderstatus = 'F'"))
    sinks.write_table(changed, path, "final")
    return sources.read_target(t.spark, path, "o_orderstatus")


@register(
    "SELECT o_orderkey, '2024-02-01' AS load_date FROM orders WHERE o_orderstatus = 'F' "
    "UNION ALL SELECT o_orderkey, '2024-02-02' FROM orders WHERE o_orderstatus <> 'F'"
)
def partitioned_append(t: Tables):
    path = scratch_path(t.spark, "dated")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    sinks.write_table(rows.filter("o_orderstatus = 'F'").drop("o_orderstatus"), path, "final", "load_date", "2024-02-01")
    sinks.write_table(rows.filter("o_orderstatus <> 'F'").drop("o_orderstatus"), path, "final", "load_date", "2024-02-02")
    return t.spark.read.parquet(path).select("o_orderkey", F.col("load_date").cast("string").alias("load_date"))


@register(
    "SELECT o_orderkey AS order_id, c_custkey AS customer_id, c_name AS customer, o_orderpriority AS priority FROM orders JOIN customer ON o_custkey = c_custkey"
)
def xml_nested_round_trip(t: Tables):
    """Tags with namespace prefixes, and elements below the rows that have the name of the rows."""
    path = scratch_path(t.spark, "orders") + ".xml"
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    record = F.format_string(
        "<x:order><x:key>%s</x:key><x:customer><x:order>%s</x:order><x:name>%s</x:name></x:customer><x:priority>%s</x:priority></x:order>",
        "o_orderkey", "c_custkey", "c_name", "o_orderpriority",
    )
    documents = rows.groupBy(F.floor(F.col("o_orderkey") / 5000)).agg(F.array_join(F.collect_list(record), "\n").alias("records"))
    texts = documents.select(F.concat(F.lit('<x:feed xmlns:x="urn:orders">\n'), "records", F.lit("\n</x:feed>")))
    texts.write.option("maxRecordsPerFile", 1).text(path)
    schema = "`x:key` bigint, `x:customer` struct<`x:order`: bigint, `x:name`: string>, `x:priority` string"
    found = sources.read_source(t.spark, path, schema=schema)
    return found.select(
        F.col("`x:key`").alias("order_id"), F.col("`x:customer`.`x:order`").alias("customer_id"),
        F.col("`x:customer`.`x:name`").alias("customer"), F.col("`x:priority`").alias("priority"),
    )


def order_runs(t: Tables, load: str = "delta", **settings):
    """A pipeline over orders, and a function that runs it once, raises what went wrong, and gives the status row."""
    specs = [
        ColumnSpec(1, "o_orderkey", "order_id", "bigint"), ColumnSpec(2, "o_totalprice", "price", "decimal", 18, 2),
    ]
    places = {"target_path": scratch_path(t.spark, "final"), "landing_path": scratch_path(t.spark, "landing")}
    spec = PipelineSpec("orders", load_type=load, **places, **settings)

    def run(source, **when):
        outcome = run_pipeline(t.spark, spec, specs, source, **when).first()
        if outcome["job_status"] != SUCCESS:
            raise RuntimeError(outcome["error_message"])
        return outcome

    return spec, run


@register(
    "SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18,2)) AS price, CASE WHEN o_orderstatus = 'P' THEN '2024-02-02' "
    "ELSE '2024-02-01' END AS load_date FROM orders"
)
def two_increments_a_day(t: Tables):
    """Three increments, two of them on one day; the first is run again after the second and replaces its own rows."""
    spec, run = order_runs(t, partition_column="load_date")
    for execution, status, day in (("1", "F", "01"), ("2", "O", "01"), ("1", "F", "01"), ("3", "P", "02")):
        run(t.orders.filter(F.col("o_orderstatus") == status), execution_id=execution, run_date=f"2024-02-{day}")
    return t.spark.read.parquet(spec.target_path).withColumn("load_date", F.col("load_date").cast("string"))


@register(
    "SELECT o_orderkey AS order_id, CAST(o_totalprice + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS price, "
    "CASE WHEN o_orderkey % 7 = 0 THEN '2024-03-04' WHEN o_orderstatus = 'F' THEN '2024-03-01' WHEN o_orderstatus = 'O' THEN '2024-03-02' "
    "ELSE '2024-03-03' END AS load_date FROM orders WHERE o_orderkey % 11 <> 0 OR o_orderkey % 7 = 0"
)
def partitioned_feed(t: Tables):
    """A change feed over three dated partitions: updates move to the day of the feed, deletes go, each key has one row."""
    spec, run = order_runs(t, partition_column="load_date", primary_key=("order_id",), change_indicator="op")
    for status, day in (("F", "01"), ("O", "02"), ("P", "03")):
        run(t.orders.filter(F.col("o_orderstatus") == status).withColumn("op", F.lit("INS")), run_date=f"2024-03-{day}")
    op = F.when(F.col("o_orderkey") % 7 == 0, "UPD").otherwise("DEL")
    feed = t.orders.filter("o_orderkey % 7 = 0 OR o_orderkey % 11 = 0").withColumns({"op": op, "o_totalprice": F.col("o_totalprice") + 1})
    run(feed, run_date="2024-03-04")
    return t.spark.read.parquet(spec.target_path).withColumn("load_date", F.col("load_date").cast("string"))


@register("SELECT o_orderkey, o_totalprice + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_totalprice FROM orders")
def interrupted_final(t: Tables):
    """A new version that was decided while its driver was lost before any folder had moved: the next reader finishes it."""
    path = scratch_path(t.spark, "final")
    price = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    sinks.write_final(t.orders.select("o_orderkey", "o_totalprice"), path)
    staged = commits.staged_folder(t.spark, path)
    t.orders.select("o_orderkey", price.alias("o_totalprice")).write.parquet(f"{staged}/data")
    commits.decide(t.spark, path, staged, [(f"{staged}/data", path)])
    return sources.read_target(t.spark, path)


@register(
    "SELECT 'r_in_set' AS rule_id, count(*) AS failing FROM orders WHERE o_orderstatus NOT IN ('F', 'O') "
    "UNION ALL SELECT 'r_between', count(*) FROM orders WHERE o_totalprice NOT BETWEEN 1000 AND 300000"
)
def error_table_append(t: Tables):
    path = scratch_path(t.spark, "errors")
    sinks.write_errors(error_rows(t.orders, ORDER_RULES, RUN), path)
    return t.spark.read.parquet(path).groupBy("rule_id").agg(F.count(F.lit(1)).alias("failing"))


@register(
    "SELECT o_orderkey AS order_id, CAST(o_totalprice + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS price FROM orders"
)
def ingest_two_loads(t: Tables):
    """A first load of the whole table and a delta load of the finished orders, through landing and final."""
    specs = [ColumnSpec(1, "o_orderkey", "order_id", "bigint"), ColumnSpec(2, "o_totalprice", "price", "decimal", 18, 2)]
    spec = PipelineSpec(
        "orders",
        target_path=scratch_path(t.spark, "final"),
        landing_path=scratch_path(t.spark, "landing"),
        load_type="delta",
        primary_key=("order_id",),
    )
    finished = t.orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for source in (t.orders, finished):
        outcome = run_pipeline(t.spark, spec, specs, source).first()
        if outcome["job_status"] != SUCCESS:
            raise RuntimeError(outcome["error_message"])
    return sources.read_target(t.spark, spec.target_path)


@register(
    "SELECT 'orders' AS pipeline_id, count(*) AS landing_count, count(*) AS final_count, 'SUCCESS' AS job_status, '' AS error_message FROM orders "
    "UNION ALL SELECT 'customers', count(*), count(*), 'SUCCESS', '' FROM customer UNION ALL SELECT 'absent', NULL, NULL, 'FAILED', 'no active version'"
)
def inventory_run(t: Tables):
    """Two file pipelines from inventory and column tables to final tables; a third is not in the inventory."""
    places = {name: scratch_path(t.spark, name) for name in ("orders", "customers")}
    sinks.write_csv_feed(order_texts(t), places["orders"] + ".csv")
    t.customer.select("c_custkey", "c_name").write.parquet(places["customers"] + ".parquet")
    inventory = t.spark.createDataFrame(
        [
            ("orders", "9", "false", places["orders"] + ".none", "", "", "full", ""),
            ("orders", "10", "true", places["orders"] + ".csv", places["orders"] + "-l", places["orders"] + "-f", "delta", '["o_orderkey"]'),
            ("customers", "1", "", places["customers"] + ".parquet", places["customers"] + "-l", places["customers"] + "-f", "full", ""),
        ],
        "pipeline_id string, version_number string, active string, source_path string, landing_path string, target_path string, "
        "load_type string, primary_key string",
    ).withColumn("primary_key", F.replace("primary_key", F.lit("o_orderkey"), F.lit("order_id")))
    specs = [("orders", "10", s) for s in ORDER_SPECS] + [
        ("customers", "1", ColumnSpec(1, "c_custkey", "id", "bigint")),
        ("customers", "1", ColumnSpec(2, "c_name", "name")),
    ]
    columns = t.spark.createDataFrame(
        [
            (p, v, str(s.sequence_number), s.source_column_name, s.target_column_name, s.target_datatype, s.target_length, s.target_precision, s.source_datetime_format)
            for p, v, s in specs
        ],
        "pipeline_id string, version_number string, sequence_number string, source_column_name string, target_column_name string, "
        "target_datatype string, target_length int, target_precision int, source_datetime_format string",
    )
    return outcomes(run_pipelines(t.spark, inventory, columns, ["orders", "customers", "absent"]))
