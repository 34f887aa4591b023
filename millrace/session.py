"""Session settings and the few places where a plan has to be cut."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
#: What goes to a Python worker at a time, besides the limit of rows; long texts make few rows.
ARROW_BATCH_BYTES = 16 * 1024 * 1024


def cluster_settings(input_bytes: int, executor_cores: int) -> dict[str, str]:
    """Spark settings for a job that shuffles about `input_bytes`.

    The initial shuffle partition count follows the data, two waves of tasks at least; adaptive execution
    merges what turns out small and splits what turns out skewed.
    """
    partitions = max(2 * executor_cores, math.ceil(input_bytes / TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(ARROW_BATCH_BYTES),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def local_session(cores: str | int = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A one-process session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`, or a temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for a table written and read back within one job."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def discard_at_exit(spark: SparkSession, path: str) -> None:
    """Let the driver delete a scratch table when the application ends."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(location)


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Later reads then see the same rows even if executors are lost, fetch only the columns they need, and give Spark true
    sizes to choose joins by.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.parquet(path)
    discard_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
