"""File sinks."""

from __future__ import annotations

import hashlib
import re
import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.project import quoted
from millrace.sinks.commits import children, commit, read_text, staged_folder, write_text
from millrace.sources.files import partition_values, remove_partition
from millrace.sources.jdbc import Database
from millrace.sources.jdbc import write_table as write_jdbc

# Fixed value: days that error rows are kept.
RETENTION_DAYS = 15


def write_landing(df: DataFrame, path: str) -> None:
    """Replace the landing copy. Spark decides on the number of files."""
    df.write.mode("overwrite").parquet(path)


def write_final(df: DataFrame, path: str) -> None:
    """Replace a table that `df` may itself be read from: write the new version beside it, decide, change folders.

    Rows are written once. Lost at any point, the table is the old version or the new one for `read_target` and for the next
    write, never half of one and never none.
    """
    spark = df.sparkSession
    staged = staged_folder(spark, path)
    df.write.parquet(f"{staged}/data")
    commit(spark, path, staged, [(f"{staged}/data", path.rstrip("/"))])


def execution_name(execution_id: str) -> str:
    """A name for files of an execution; different ids never have names of which one begins with the other and a dash."""
    return f"{re.sub('[^A-Za-z0-9]', '-', execution_id).strip('-')}-{hashlib.md5(execution_id.encode()).hexdigest()[:12]}"


def written_by(spark: SparkSession, path: str, execution_id: str) -> list[str]:
    """Files of a partitioned table that an execution has added before."""
    name = execution_name(execution_id)
    folder = read_text(spark, f"{path.rstrip('/')}/_executions/{name}")
    files = children(spark, f"{path.rstrip('/')}/{folder}") if folder else []
    return [f for f in files if f.rpartition("/")[2].startswith(f"{name}-")]


def staged_files(spark: SparkSession, staged: str, path: str, folder: str, execution_id: str) -> list[tuple[str, str]]:
    """Moves that add the files of `staged`/data to a partition folder, and a note of the execution to the table."""
    name, attempt = execution_name(execution_id), uuid.uuid4().hex[:12]
    write_text(spark, f"{staged}/note", folder)
    files = children(spark, f"{staged}/data")
    ends = [f"{path.rstrip('/')}/{folder}/{name}-{attempt}-{k:05d}.parquet" for k in range(len(files))]
    return [*zip(files, ends), (f"{staged}/note", f"{path.rstrip('/')}/_executions/{name}")]


def partition_folder(spark: SparkSession, column: str, value: object) -> str:
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{names.escapePathName(column)}={names.escapePathName(str(value))}"


def append_execution(
    df: DataFrame, path: str, partition_column: str, run_date: date | str, execution_id: str
) -> None:
    """Add rows under `<partition_column>=<run date>`, once for each execution: a repeated one replaces its own rows, whatever
    date it had before, and leaves those of other executions of that day alone."""
    spark = df.sparkSession
    staged = staged_folder(spark, path)
    before = written_by(spark, path, execution_id)
    df.drop(partition_column).write.parquet(f"{staged}/data")
    folder = partition_folder(spark, partition_column, run_date)
    commit(spark, path, staged, staged_files(spark, staged, path, folder, execution_id), before)


def write_partition(
    df: DataFrame, path: str, partition_column: str, run_date: date | str, replace: bool = False
) -> None:
    """Add rows under `<partition_column>=<run date>`. With `replace` a repeated run replaces its own partition."""
    dated = df.withColumn(partition_column, F.lit(str(run_date)))
    writer = dated.write.partitionBy(partition_column)
    if replace:
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    else:
        writer.mode("append").parquet(path)


def write_errors(errors: DataFrame, path: str) -> None:
    """Append error rows, all as strings, under `run_dt=<date>`."""
    texts = errors.select(*[quoted(c).cast("string").alias(c) for c in errors.columns])
    texts.write.partitionBy("run_dt").mode("append").parquet(path)


def write_csv_feed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_config_per_app(df: DataFrame, path: str, app_column: str = "app_name") -> None:
    """One folder of JSON documents per application."""
    df.write.partitionBy(app_column).mode("overwrite").json(path)


def write_table(
    df: DataFrame,
    path: str,
    zone: str,
    partition_column: str | None = None,
    run_date: date | str | None = None,
    execution_id: str | None = None,
) -> None:
    """Write to a zone: 'landing' replaces, 'final' replaces by a new version, or adds to the run date's partition, where a
    repeated execution replaces what it has added before. Without an id every call is an execution of its own."""
    if zone == "landing":
        write_landing(df, path)
    elif zone != "final":
        raise ValueError("zone must be 'landing' or 'final'")
    elif partition_column:
        append_execution(df, path, partition_column, run_date or date.today(), execution_id or uuid.uuid4().hex)
    else:
        write_final(df, path)


def keep_recent(df: DataFrame, column: str, as_of: date | str, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows dated at most `days` days before `as_of`. On a partition column this prunes partitions."""
    oldest = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    kind = df.schema[column].dataType
    return df.filter(quoted(column) >= oldest.cast(kind))


def purge(spark: SparkSession, path: str, column: str, as_of: date | str, days: int = RETENTION_DAYS) -> list[str]:
    """Remove a table's partitions dated more than `days` days before `as_of`; return their dates.

    Only folders go, so the cost does not depend on how much data stays.
    """
    oldest = str(date.fromisoformat(str(as_of)) - timedelta(days=days))
    expired = [value for value in partition_values(spark, path, column) if value < oldest]
    for value in expired:
        remove_partition(spark, path, column, value)
    return expired


def write_frame(df: DataFrame, target: str | Database, name: str | None = None, mode: str = "overwrite") -> None:
    """Write to a path, or to the named table of a database."""
    if isinstance(target, Database):
        write_jdbc(df, target, name, mode)
    else:
        df.write.mode(mode).parquet(target)
