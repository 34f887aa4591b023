"""Pipeline inventory and job status. `events` plays the status table, `part` the inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import json_value
from millrace.operators import filters
from millrace.plans import pipelines
from millrace.queries import Tables, register
from millrace.sinks.files import keep_recent
from millrace.streaming.kafka import payload


@register(
    "SELECT p_brand AS pipeline_id, CAST(max(p_size) AS VARCHAR) AS version_number FROM part "
    "WHERE p_type <> 'ECONOMY' GROUP BY p_brand"
)
def latest_active_version(t: Tables):
    inventory = t.part.select(
        F.col("p_brand").alias("pipeline_id"),
        F.col("p_size").cast("string").alias("version_number"),
        F.when(F.col("p_type") == "ECONOMY", F.lit("false")).otherwise(F.lit("")).alias("active"),
    )
    return pipelines.latest_active_versions(inventory)


@register("SELECT p_brand AS pipeline_id, p_partkey FROM part WHERE p_brand IN ('Brand#2', 'Brand#11')")
def pipeline_selection(t: Tables):
    inventory = t.part.select(F.col("p_brand").alias("pipeline_id"), "p_partkey")
    found, _ = pipelines.select_pipelines(inventory, ["Brand#2", "Brand#11", "absent"])
    return found


@register(
    "SELECT user_id, coalesce(max(ts) FILTER (WHERE event_type = 'purchase' AND value > 200), TIMESTAMP '1900-01-01') AS ts "
    "FROM events GROUP BY user_id"
)
def last_success(t: Tables):
    outcome = (F.col("event_type") == "purchase") & (F.col("value") > 200)
    status = t.events.withColumn("outcome", F.when(outcome, F.lit(pipelines.SUCCESS)).otherwise(F.lit(pipelines.FAILURE)))
    return pipelines.last_success(status, "user_id", "ts", "outcome")


def _runs(t: Tables, kind: str):
    return t.events.filter(F.col("event_type") == kind).select(
        F.col("user_id").cast("string").alias("pipeline_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("execution_id"),
        F.col("event_id").alias("execution_end_dttm"),
        F.col("event_type").alias("job_status"),
    )


@register(
    "WITH r AS (SELECT CAST(user_id AS VARCHAR) AS pipeline_id, strftime(ts, '%Y-%m-%d') AS execution_id, "
    "event_id AS execution_end_dttm, event_type AS job_status FROM events), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY pipeline_id, execution_id, job_status ORDER BY execution_end_dttm DESC) rn FROM r), "
    "a AS (SELECT * FROM n WHERE job_status = 'view' AND rn = 1), b AS (SELECT * FROM n WHERE job_status = 'purchase' AND rn = 1) "
    "SELECT pipeline_id, execution_id, execution_end_dttm, job_status FROM b UNION ALL SELECT pipeline_id, execution_id, "
    "execution_end_dttm, job_status FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.pipeline_id = a.pipeline_id AND b.execution_id = a.execution_id)"
)
def job_status_update(t: Tables):
    before = pipelines.update_status(None, _runs(t, "view"))
    return pipelines.update_status(before, _runs(t, "purchase"))


@register(
    "SELECT event_id, CASE event_type WHEN 'view' THEN 'not applicable' WHEN 'click' THEN CASE WHEN 60 > value THEN 'true' ELSE 'false' END "
    "ELSE CASE WHEN 3600 * 0 + 60 * 1 + 30 > value THEN 'true' ELSE 'false' END END AS sla_met FROM events"
)
def sla_status(t: Tables):
    sla = (
        F.when(F.col("event_type") == "view", F.lit(""))
        .when(F.col("event_type") == "click", F.lit("00:01:00"))
        .otherwise(F.lit("00:01:30"))
    )
    return t.events.select("event_id", filters.sla_met(sla, "value").alias("sla_met"))


@register(
    "SELECT event_id, event_type = 'click' AND CAST(date_trunc('second', ts) AS TIME) BETWEEN TIME '08:00:00' AND TIME '12:30:00' AS blocked FROM events"
)
def ola_blackout(t: Tables):
    ola = F.when(F.col("event_type") == "click", F.lit("08:00:00-12:30:00")).otherwise(F.lit(""))
    return t.events.select("event_id", pipelines.in_blackout(ola, "ts").alias("blocked"))


@register(
    "WITH n AS (SELECT *, (row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) - 1) // 10 AS part FROM part) "
    "SELECT p_brand AS pipeline_id, p_type AS version_number, part, CAST(to_json(list({sequence_number: CAST(p_partkey AS VARCHAR), "
    "source_column_name: p_name, source_datatype: 'int', source_length: p_size, source_precision: CAST(NULL AS INTEGER), "
    "source_datetime_format: CAST(NULL AS VARCHAR), target_column_name: p_name, target_datatype: 'decimal', target_length: 38, "
    "target_precision: 2, target_datetime_format: CAST(NULL AS VARCHAR), transformation_logic: ''} ORDER BY p_partkey)) AS VARCHAR) AS pipeline_columns "
    "FROM n GROUP BY p_brand, p_type, part"
)
def pipeline_column_lists(t: Tables):
    columns = t.part.select(
        F.col("p_brand").alias("pipeline_id"),
        F.col("p_type").alias("version_number"),
        F.col("p_partkey").cast("string").alias("sequence_number"),
        F.col("p_name").alias("source_column_name"),
        F.lit("int").alias("source_datatype"),
        F.col("p_size").alias("source_length"),
        F.lit(None).cast("int").alias("source_precision"),
        F.lit(None).cast("string").alias("source_datetime_format"),
        F.col("p_name").alias("target_column_name"),
        F.lit("decimal").alias("target_datatype"),
        F.lit(38).alias("target_length"),
        F.lit(2).alias("target_precision"),
        F.lit(None).cast("string").alias("target_datetime_format"),
        F.lit("").alias("transformation_logic"),
    )
    return pipelines.pipeline_column_lists(columns, rows_per_part=10)


@register("SELECT concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment) AS value FROM customer")
def kafka_payload(t: Tables):
    return payload(t.customer, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


@register("SELECT event_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - 15")
def retention_keep(t: Tables):
    dated = t.events.select("event_id", F.col("ts").cast("date").alias("run_dt"))
    return keep_recent(dated, "run_dt", "2024-01-31").select("event_id")


@register("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_field(t: Tables):
    return t.events.select("event_id", json_value("props", "k", "int").alias("k"))
