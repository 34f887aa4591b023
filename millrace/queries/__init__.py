"""Queries over the shared test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The Parquet tables of one folder, by attribute: `t.orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def register(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a query under its function name, with its SQL unless it has none."""

    def add(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = function.__name__
        if name in QUERIES:
            raise KeyError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def load_all() -> None:
    from millrace.queries import (  # noqa: F401
        aggregates,
        bonds,
        catalog,
        changes,
        files,
        flows,
        joins,
        methodology,
        pipelines,
        projections,
        quality,
        reconciliation,
        selections,
    )
