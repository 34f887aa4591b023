"""External tables, partition discovery and views, as Spark SQL statements."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.conform import ColumnSpec, in_sequence

# Fixed value: digits of a decimal whose length is not given.
DECIMAL_LENGTH = 38


def table_type(kind: str, length: int | None = None, precision: int | None = None) -> str:
    """The type of a table column: DATETIME is TIMESTAMP, a STRING with a length is VARCHAR, DECIMAL has 38 digits."""
    name = kind.strip().lower()
    if name == "datetime":
        return "TIMESTAMP"
    if name in ("string", "varchar2"):
        return "STRING" if length is None else f"VARCHAR({length})"
    if name in ("char", "varchar"):
        if length is None:
            raise ValueError(f"{name} needs a length")
        return f"{name.upper()}({length})"
    if name == "decimal":
        return f"DECIMAL({length or DECIMAL_LENGTH},{precision or 0})"
    return name.upper()


def spec_columns(specs: Iterable[ColumnSpec]) -> list[tuple[str, str]]:
    return [
        (s.target_column_name, table_type(s.target_datatype, s.target_length, s.target_precision))
        for s in in_sequence(specs)
    ]


def create_table_statement(
    name: str, columns: Iterable[tuple[str, str]], path: str, partition_column: str | None = None
) -> str:
    """The statement for an external Parquet table, with at most one string partition column."""
    listed = [(c, t) for c, t in columns if c != partition_column]
    if partition_column:
        listed.append((partition_column, "STRING"))
    body = ", ".join(f"`{c}` {t}" for c, t in listed)
    partition = f" PARTITIONED BY (`{partition_column}`)" if partition_column else ""
    return f"CREATE TABLE {name} ({body}) USING PARQUET{partition} LOCATION '{path}'"


def create_external_table(
    spark: SparkSession,
    name: str,
    columns: Iterable[tuple[str, str]],
    path: str,
    partition_column: str | None = None,
) -> None:
    """Define the table anew. Dropping an external table leaves its files alone."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(create_table_statement(name, columns, path, partition_column))


def create_table_from_specs(
    spark: SparkSession, name: str, specs: Iterable[ColumnSpec], path: str, partition_column: str | None = None
) -> None:
    create_external_table(spark, name, spec_columns(specs), path, partition_column)


def create_table_like(
    df: DataFrame, name: str, path: str, partition_column: str | None = None
) -> None:
    create_external_table(df.sparkSession, name, df.dtypes, path, partition_column)


def discover_partitions(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")


def create_view(spark: SparkSession, name: str, query: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def create_temporary_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
