"""Runs driven by the inventory: records become specs, sources are read by kind, several pipelines give one status table."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import fields
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.conform import ColumnSpec, source_names
from millrace.operators.filters import windowed_query
from millrace.plans.ingest import business_window, run_by_day, run_pipeline
from millrace.plans.pipelines import FAILURE, PipelineSpec, latest_active_versions, select_pipelines, status_row, update_status
from millrace.sources.files import read_source
from millrace.sources.jdbc import Database, read_query
from millrace.streaming.kafka import read_topic

# How a moment is written in a database's SQL.
MOMENTS = {
    "oracle": "to_timestamp('{}','yyyy-MM-dd hh24:mi:ss')",
    "postgres": "timestamp '{}'",
    "": "'{}'",
}


def spec_from_record(record: Mapping[str, object]) -> PipelineSpec:
    """From an inventory record, where every value may be text, '' means absent and lists may be JSON texts."""
    values: dict[str, object] = {}
    for field in fields(PipelineSpec):
        value = record.get(field.name)
        if value in (None, "", "null", "[]"):
            continue
        if field.name in ("primary_key", "cdc_timestamp_columns"):
            listed = json.loads(value.replace("'", '"')) if isinstance(value, str) and value.startswith("[") else value
            value = tuple(listed.split(",")) if isinstance(listed, str) else tuple(listed)
        elif field.name == "header" and isinstance(value, str):
            value = value.strip().lower() == "true"
        values[field.name] = value
    return PipelineSpec(**values)


def source_query(
    table: str,
    specs: Iterable[ColumnSpec],
    stamps: Iterable[str] = (),
    since: datetime | str | None = None,
    until: datetime | str | None = None,
    dialect: str = "",
    template: str = "",
) -> str:
    """The SQL that reads a window of a table: the column list in sequence order, and any change stamp in the window.

    A template takes the two ends in its `{}`; without an earlier run the whole table is read, as by a first load.
    """
    everything = f"select {', '.join(source_names(specs))} from {table}"
    if template:
        return windowed_query(template, since, until, everything)
    stamps = list(stamps)
    if not stamps or since is None:
        return everything
    low, high = (MOMENTS[dialect].format(str(t)[:19]) for t in (since, until))
    return f"{everything} where {' or '.join(f'{s} between {low} and {high}' for s in stamps)}"


def read_by_kind(
    spark: SparkSession,
    record: Mapping[str, object],
    spec: PipelineSpec,
    specs: Iterable[ColumnSpec],
    since: str | None,
    until: str,
    databases: Mapping[str, Database] | None = None,
) -> DataFrame:
    """The source of an inventory record by its `source_type`: 'file' (the default), 'kafka', or a database's name."""
    kind = str(record.get("source_type") or "file").lower()
    if kind in ("file", "s3"):
        return read_source(spark, spec.source_path, specs, header=spec.header, delimiter=spec.delimiter, row_tag=spec.row_tag)
    if kind == "kafka":
        return read_topic(spark, str(record["source_servers"]), str(record["source_topic"]))
    if kind not in (databases or {}):
        raise ValueError(f"no source of type {kind}")
    window = (since, until) if spec.load_type == "delta" else (None, None)
    text = source_query(
        str(record["source_table_name"]), specs, spec.cdc_timestamp_columns, *window,
        dialect=str(record.get("source_dialect") or ""), template=str(record.get("source_query") or ""),
    )
    return read_query(spark, databases[kind], text)


def run_pipelines(
    spark: SparkSession,
    inventory: DataFrame,
    columns: DataFrame,
    wanted: Iterable[str] | None = None,
    version: object = None,
    status: DataFrame | None = None,
    since: datetime | str | None = None,
    until: datetime | str | None = None,
    by_day: bool = False,
    databases: Mapping[str, Database] | None = None,
    run_date: date | str | None = None,
) -> DataFrame:
    """Run the wanted pipelines (all active ones by default) in their latest versions, one after the other.

    Returns the job status table with their rows; a wanted pipeline that is missing, inactive or of another version gets a
    row that says so. With `by_day`, days are run from the last success on. The driver reads the inventory records of the
    chosen pipelines and their columns, nothing else.
    """
    latest = latest_active_versions(inventory)
    chosen, missing = latest, None
    if wanted is not None:
        chosen, missing = select_pipelines(latest, wanted, version)
    records = inventory.join(chosen, ["pipeline_id", "version_number"], "left_semi").orderBy("pipeline_id").collect()
    listed = columns.join(chosen, ["pipeline_id", "version_number"], "left_semi").collect()
    until = until or datetime.now()
    rows = [
        status_row(spark, pipeline_id=r["pipeline_id"], execution_id=r["pipeline_id"], job_status=FAILURE, error_message="no active version")
        for r in (missing.collect() if missing is not None else [])
    ]
    for record in (r.asDict(True) for r in records):
        spec = spec_from_record(record)
        specs = [ColumnSpec.from_record(c.asDict()) for c in listed if c["pipeline_id"] == spec.pipeline_id]
        low, high = business_window(spec, status, since, until)
        try:
            source = read_by_kind(spark, record, spec, specs, low, high, databases)
        except Exception as error:  # noqa: BLE001 - one source that cannot be read leaves the others alone
            rows.append(status_row(spark, pipeline_id=spec.pipeline_id, execution_id=spec.pipeline_id, job_status=FAILURE, error_message=str(error)))
            continue
        if by_day and low is not None:
            rows.append(run_by_day(spark, spec, specs, source, low, high))
        else:
            rows.append(run_pipeline(spark, spec, specs, source, status, since=low, until=high, run_date=run_date))
    if not rows:
        raise ValueError("no pipeline has an active version")
    return update_status(status, reduce(lambda a, b: a.unionByName(b), rows), ["execution_start_dttm"])


def outcomes(status: DataFrame) -> DataFrame:
    """What a run did, without its times and random ids."""
    return status.select("pipeline_id", "landing_count", "final_count", "job_status", F.coalesce("error_message", F.lit("")).alias("error_message"))
