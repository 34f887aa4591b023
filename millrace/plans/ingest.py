"""One ingestion run: scan, land, conform, merge, write, record."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.cdc import daily_windows, merge, unique_keys
from millrace.functions.columns import any_of
from millrace.operators.conform import ColumnSpec, conform, moment
from millrace.operators.filters import FIRST_WATERMARK, incremental_window, sla_met
from millrace.operators.project import quoted
from millrace.plans.pipelines import FAILURE, SUCCESS, PipelineSpec, blackout_now, status_row, watermark
from millrace.sinks.files import write_landing, write_table
from millrace.session import cut
from millrace.sinks.partitions import merge_into_partitions
from millrace.sources import jdbc
from millrace.sources.files import read_source, read_target
from millrace.sources.jdbc import Database


def planned_target(
    spec: PipelineSpec, specs: Iterable[ColumnSpec], landed: DataFrame, target: DataFrame | None
) -> DataFrame:
    """What the final table holds after this run; of a table with a partition column, what the run adds to it.

    Landed rows and target are stored tables, so the merge may look up the touched key range first.
    """
    specs = list(specs)
    incoming = conform(landed, specs, spec.change_indicator)
    if spec.load_type != "delta":
        return incoming
    indicator = spec.change_indicator if spec.change_indicator in incoming.columns else None
    newest_by = newest_columns(spec, specs)
    if spec.partition_column:
        return unique_keys(incoming, spec.primary_key, newest_by)
    return merge(target, incoming, spec.primary_key, indicator, by_range=True, newest_by=newest_by)


def newest_columns(spec: PipelineSpec, specs: Iterable[ColumnSpec]) -> list[str]:
    """The change timestamps by their names in the target."""
    named = {s.source_column_name: s.target_column_name for s in specs}
    return [named[c] for c in spec.cdc_timestamp_columns if c in named]


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The table with its row count measured while it is written, instead of by a job of its own."""
    observation = Observation(f"{name}-{uuid.uuid4().hex}")
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def business_window(
    spec: PipelineSpec, status: DataFrame | None, since: datetime | str | None, until: datetime | str
) -> tuple[str | None, str]:
    """(from, until) of a run: from the given time, or the last successful start, or None before the first."""
    if since is None and status is not None:
        since = watermark(status, spec.pipeline_id)
    first = since is None or str(since) == str(FIRST_WATERMARK)
    return None if first else str(since), str(until)


def increment(spec: PipelineSpec, specs: Iterable[ColumnSpec], source: DataFrame, since: str | None, until: str) -> DataFrame:
    """The source rows that changed in a window; all of them for a full load or without a change timestamp.

    Texts are read by the formats of their column specs first. Without `since` (a first load) only rows that are known to
    be later than `until` wait for the next run; rows without a readable timestamp are loaded.
    """
    names = list(spec.cdc_timestamp_columns)
    if not names or spec.load_type != "delta":
        return source
    known = {s.source_column_name: s for s in specs}
    texts = [c for c in names if isinstance(source.schema[c].dataType, T.StringType)]

    def moment_of(name: str) -> Column:
        if name not in texts:
            return quoted(name).cast("timestamp_ntz")
        if name not in known:
            return quoted(name).try_cast("timestamp_ntz")
        return moment(replace(known[name], target_datetime_format=None), quoted(name), True).cast("timestamp_ntz")

    if since is None:
        late = [moment_of(c) > F.lit(until).cast("timestamp_ntz") for c in names]
        return source.filter(~F.coalesce(reduce(lambda a, b: a & b, late), F.lit(False)))
    if not texts:
        return incremental_window(source, names, since, until)  # plain comparisons, which the scan can use
    low, high = (F.lit(t).cast("timestamp_ntz") for t in (since, until))
    return source.filter(any_of(moment_of(c).between(low, high) for c in names))


def store_in_files(
    spark: SparkSession, spec: PipelineSpec, specs: Sequence[ColumnSpec], landed: DataFrame, day: date | str, execution: str
) -> int:
    """Merge landed rows into the target's files; the rows written, of change feeds over partitions those that are new."""
    delta, column = spec.load_type == "delta", spec.partition_column
    target = read_target(spark, spec.target_path) if delta and not column else None
    planned = planned_target(spec, specs, landed, target)
    if delta and column and spec.change_indicator in planned.columns:
        return merge_into_partitions(spark, spec.target_path, planned, spec.primary_key, column, day, execution, spec.change_indicator)
    measured, final = counted(planned, "final")
    write_table(measured, spec.target_path, "final", column, day, execution)
    return final.get["rows"]


def store_in_database(
    spark: SparkSession, spec: PipelineSpec, specs: Sequence[ColumnSpec], landed: DataFrame, database: Database
) -> int:
    """Merge landed rows into a table of a database; the rows written. The merged rows are kept in the shared folder first, as
    they are read from the table that is then written over."""
    target = jdbc.read_target(spark, database, spec.target_table) if spec.load_type == "delta" else None
    measured, final = counted(planned_target(replace(spec, partition_column=None), specs, landed, target), "final")
    jdbc.write_table(cut(measured), database, spec.target_table)
    return final.get["rows"]


def run_pipeline(
    spark: SparkSession,
    spec: PipelineSpec,
    specs: Iterable[ColumnSpec],
    source: DataFrame | None = None,
    status: DataFrame | None = None,
    started: datetime | None = None,
    since: datetime | str | None = None,
    until: datetime | str | None = None,
    run_date: date | str | None = None,
    execution_id: str | None = None,
    database: Database | None = None,
) -> DataFrame:
    """Run one pipeline and return its job status row; a failure is reported in the row.

    The source is landed, and everything after reads the landed copy. An empty increment (looked for first) writes nothing
    and counts as success. Of repeated keys in a delta the newest by the change timestamps counts; without such columns they
    are a failure. Row counts come with the writes.

    A target with a partition column gets the rows under the run date. A change feed moves the touched keys there from the
    partitions they lie in; other loads add rows to those of earlier runs of that day. A run that is repeated, under its
    `execution_id` or without one over the same window, replaces what it added before.

    With a `database` the target is its table `spec.target_table`: it is read for the merge, the result is kept in the shared
    folder, and then written over it.
    """
    specs = list(specs)
    began = time.monotonic()
    started = started or datetime.now()
    base = {
        "pipeline_id": spec.pipeline_id,
        "execution_id": execution_id or f"{spec.pipeline_id}_{uuid.uuid4().hex}",
        "table_name": spec.target_table,
        "execution_start_dttm": started.strftime("%Y-%m-%d %H:%M:%S"),
        "load_type": spec.load_type,
        "frequency_type": spec.frequency_type,
    }
    try:
        if blackout_now(spec.ola, started):
            raise RuntimeError("start time lies in the blackout window")
        low, high = business_window(spec, status, since, until or started)
        base |= {"business_order_from_dttm": low or str(FIRST_WATERMARK), "business_order_to_dttm": high}
        if source is None:
            source = read_source(
                spark, spec.source_path, specs, header=spec.header, delimiter=spec.delimiter, row_tag=spec.row_tag
            )
        rows = increment(spec, specs, source, low, high)
        landing_count = final_count = 0
        if not rows.isEmpty():
            measured, landing = counted(rows, "landing")
            write_landing(measured, spec.landing_path)
            landing_count = landing.get["rows"]
        if landing_count:
            landed = spark.read.schema(rows.schema).parquet(spec.landing_path)
            if database is not None:
                final_count = store_in_database(spark, spec, specs, landed, database)
            else:
                execution = execution_id or f"{spec.pipeline_id} {low} {high}"
                final_count = store_in_files(spark, spec, specs, landed, run_date or started.date(), execution)
    except Exception as error:  # noqa: BLE001 - the outcome of a run is data
        return status_row(
            spark, **base, execution_end_dttm=_now(), job_status=FAILURE, error_message=str(error), sla_met=""
        )
    done = status_row(
        spark,
        **base,
        execution_end_dttm=_now(),
        landing_count=landing_count,
        final_count=final_count,
        processed_count=0,
        error_message="",
        job_status=SUCCESS,
    )
    return done.withColumn("sla_met", sla_met(F.lit(spec.sla), F.lit(time.monotonic() - began)))


def run_by_day(
    spark: SparkSession,
    spec: PipelineSpec,
    specs: Iterable[ColumnSpec],
    source: DataFrame,
    since: datetime | str,
    until: datetime | str,
) -> DataFrame:
    """Run one pipeline once per calendar day between two times, in order, up to the first failure; the status rows.

    A day is a whole Spark job; only the list of days is walked here.
    """
    specs = list(specs)
    days = daily_windows(spark, since, until).orderBy("day").collect()
    outcomes = []
    for d in days:
        outcomes.append(run_pipeline(spark, spec, specs, source, since=d["window_start"], until=d["window_end"], run_date=d["day"]))
        if outcomes[-1].filter(F.col("job_status") == FAILURE).count():
            break  # later days build on this one
    return reduce(lambda a, b: a.union(b), outcomes)


def _now() -> str:
    return datetime.now().strftime("%Y-%m-%d %H:%M:%S")
