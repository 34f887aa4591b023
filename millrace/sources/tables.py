"""Catalog tables and SQL over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def spark_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run a query. Tables of the catalog go by name, DataFrames as `{name}`; no global view is left behind."""
    return spark.sql(query, **tables)
