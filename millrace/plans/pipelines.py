"""Pipeline inventory and job status, as tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import seconds_of, to_column
from millrace.operators.aggregate import group_to_json_array
from millrace.operators.cdc import newest_per_key, upsert
from millrace.operators.filters import FIRST_WATERMARK
from millrace.operators.joins import anti_join, semi_join
from millrace.sinks.files import write_final
from millrace.sources.files import read_target

# Outcomes of a run.
SUCCESS = "SUCCESS"
FAILURE = "FAILED"

# The columns of the job status table.
JOB_STATUS = (
    "pipeline_id string, execution_id string, table_name string, execution_start_dttm string, "
    "execution_end_dttm string, business_order_from_dttm string, business_order_to_dttm string, load_type string, "
    "load_phase string, frequency_type string, landing_count long, final_count long, processed_count long, "
    "error_message string, job_status string, sla_met string"
)

# The fields of a pipeline's column list.
PIPELINE_COLUMN_FIELDS = [
    "sequence_number",
    "source_column_name",
    "source_datatype",
    "source_length",
    "source_precision",
    "source_datetime_format",
    "target_column_name",
    "target_datatype",
    "target_length",
    "target_precision",
    "target_datetime_format",
    "transformation_logic",
]


@dataclass(frozen=True)
class PipelineSpec:
    """The settings of one pipeline."""

    pipeline_id: str
    source_path: str = ""
    target_path: str = ""
    landing_path: str = ""
    load_type: str = "full"
    primary_key: tuple[str, ...] = ()
    cdc_timestamp_columns: tuple[str, ...] = ()
    change_indicator: str | None = None
    partition_column: str | None = None
    target_table: str = ""
    frequency_type: str = ""
    ola: str = ""
    sla: str = ""
    header: bool | None = None
    delimiter: str | None = None
    row_tag: str | None = None


def is_active(active: str | Column) -> Column:
    """A blank flag means active."""
    text = F.lower(F.trim(to_column(active).cast("string")))
    return text.isNull() | text.isin("", "true")


def latest_active_versions(
    inventory: DataFrame,
    pipeline: str = "pipeline_id",
    version: str = "version_number",
    active: str | Column = "active",
    as_text: bool = False,
) -> DataFrame:
    """Each pipeline's highest active version, compared as a number ('10' after '9') unless `as_text`."""
    number = F.col(version) if as_text else F.col(version).cast("string").try_cast("decimal(38,6)")
    return (
        inventory.filter(is_active(active))
        .groupBy(pipeline)
        .agg(F.max_by(F.col(version), number).alias(version))
    )


def select_pipelines(
    latest: DataFrame, wanted: Iterable[str], version: object = None, pipeline: str = "pipeline_id"
) -> tuple[DataFrame, DataFrame]:
    """(rows of the wanted pipelines, wanted ids that are missing). With a version, any other one counts as missing."""
    rows = latest if version is None else latest.filter(F.col("version_number") == version)
    ids = latest.sparkSession.createDataFrame([(i,) for i in wanted], f"{pipeline} string")
    return semi_join(rows, ids, pipeline), anti_join(ids, rows, pipeline)


def last_success(status: DataFrame, pipeline: str, start: str, outcome: str, success: object = SUCCESS) -> DataFrame:
    """Per pipeline, the newest start among its successful runs; 1900-01-01 where there is none."""
    never = F.lit(str(FIRST_WATERMARK)).cast(status.schema[start].dataType)
    newest = F.max(F.when(F.col(outcome) == success, F.col(start)))
    return status.groupBy(pipeline).agg(F.coalesce(newest, never).alias(start))


def watermark(status: DataFrame, pipeline_id: str) -> str:
    """The start of a pipeline's newest successful run, for the next incremental window."""
    runs = status.filter((F.col("pipeline_id") == pipeline_id) & (F.col("job_status") == SUCCESS))
    newest = runs.agg(F.max("execution_start_dttm")).first()[0]
    return str(FIRST_WATERMARK) if newest is None else str(newest)


def status_row(spark: SparkSession, **values: object) -> DataFrame:
    """One row of the job status table; what is not given is NULL."""
    names = [field.split(" ")[0] for field in JOB_STATUS.split(", ")]
    unknown = set(values) - set(names)
    if unknown:
        raise KeyError(f"no such status column: {', '.join(sorted(unknown))}")
    return spark.createDataFrame([tuple(values.get(n) for n in names)], JOB_STATUS)


def update_status(
    status: DataFrame | None, changes: DataFrame, newest_by: Sequence[str] = ("execution_end_dttm",)
) -> DataFrame:
    """Upsert status rows by (pipeline, execution); of several changes to one run the newest counts."""
    keys = ["pipeline_id", "execution_id"]
    return upsert(status, newest_per_key(changes, keys, newest_by), keys)


def stored_status(spark: SparkSession, path: str) -> DataFrame | None:
    """The job status table as the last run left it, or None before the first."""
    return read_target(spark, path)


def store_status(path: str, changes: DataFrame, newest_by: Sequence[str] = ("execution_end_dttm",)) -> DataFrame:
    """Put changes into the stored status table, by one commit; the table as it is now."""
    spark = changes.sparkSession
    write_final(update_status(stored_status(spark, path), changes, newest_by), path)
    return stored_status(spark, path)


def in_blackout(ola: str | Column, moment: str | Column) -> Column:
    """True when a time of day lies in the `HH:MM:SS-HH:MM:SS` in which a pipeline must not start."""
    ends = F.split(to_column(ola), "-")
    low, high = (seconds_of(F.trim(F.get(ends, F.lit(i)))) for i in range(2))
    at = to_column(moment)
    now = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    return F.coalesce(now.between(low, high), F.lit(False))


def blackout_now(ola: str, moment: datetime) -> bool:
    """The same for one pipeline about to start, by the same rule."""
    spark = SparkSession.active()
    at = F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return bool(spark.range(1).select(in_blackout(F.lit(ola), at)).first()[0])


ENVIRONMENTS = "array<map<string,string>>"


def environment_entry(environments: str | Column, environment: str) -> Column:
    """The entry of a JSON list that is for an environment, letter case aside; the last one, if several are."""
    listed = F.from_json(to_column(environments), ENVIRONMENTS)
    wanted = F.filter(listed, lambda e: F.lower(F.try_element_at(e, F.lit("environment_name"))) == environment.lower())
    return F.try_element_at(wanted, F.lit(-1))


def storage_location(environments: str | Column, environment: str, scheme: str = "s3://") -> Column:
    """Where an environment's final data lie."""
    bucket = F.try_element_at(environment_entry(environments, environment), F.lit("target_bucket_name"))
    return F.concat(F.lit(scheme), bucket, F.lit("/data/final"))


def pipeline_column_lists(columns: DataFrame, rows_per_part: int) -> DataFrame:
    """Each pipeline version's columns as a JSON array, in sequence order; the key is (pipeline_id, version_number, part)."""
    numbered = columns.withColumn("__sequence", F.col("sequence_number").cast("string").try_cast("int"))
    return group_to_json_array(
        numbered,
        ["pipeline_id", "version_number"],
        PIPELINE_COLUMN_FIELDS,
        ["__sequence", "target_column_name"],
        rows_per_part,
        "pipeline_columns",
    )


def pipeline_configs(inventory: DataFrame, columns: DataFrame, rows_per_part: int) -> DataFrame:
    """Inventory rows with their column lists, one row per `part` of a list; nested fields become JSON texts."""
    texts = [
        F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map") else F.col(f.name)
        for f in inventory.schema.fields
    ]
    lists = pipeline_column_lists(columns, rows_per_part)
    return inventory.select(*texts).join(lists, ["pipeline_id", "version_number"])
