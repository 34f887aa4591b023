"""Kafka as a bounded source and as a sink. Needs the Kafka package of Spark on the class path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.project import quoted


def scan_options(
    servers: str, topic: str, starting_offsets: str = "earliest", ending_offsets: str = "latest"
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "endingOffsets": ending_offsets,
    }


def read_topic(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest") -> DataFrame:
    """Everything between the starting offsets and the latest, as one batch."""
    return spark.read.format("kafka").options(**scan_options(servers, topic, starting_offsets)).load()


def payload(df: DataFrame, columns: Sequence[str] | None = None, separator: str = "|") -> DataFrame:
    """All columns as one `value`, joined by a separator; a NULL leaves an empty field, so positions stay fixed."""
    texts = [F.coalesce(quoted(c).cast("string"), F.lit("")) for c in (columns or df.columns)]
    return df.select(F.concat_ws(separator, *texts).alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    payload(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
