"""Feeds for a data catalog: one row per table and per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import PROCESSED_TYPE_NAMES, RAW_TYPE_NAMES, catalog_type_name, community_name, decimal_part
from millrace.operators.aggregate import distinct_on
from millrace.operators.filters import active_published
from millrace.operators.project import labelled
from millrace.plans.lineage import FINAL
from millrace.plans.pipelines import storage_location
from millrace.session import cut

# The labels of a catalog row, in feed order, and two constants in it.
LABELS = [
    "Full Name",
    "Name",
    "Community",
    "Domain Type",
    "Domain",
    "Asset Type",
    "Data Type",
    "Data Type Precision",
    "Size",
    "Data Classification",
    "File Location",
    "Format",
    "Description",
    "is part of [Table] > Name",
    "is part of [Table] > Full Name",
    "is part of [Table] > Community",
    "is part of [Table] > Domain",
]
DOMAIN_TYPE = "Physical Data Dictionary"
DEFAULT_CLASSIFICATION = "INTERNAL"


def catalog_rows(df: DataFrame, values: dict[str, Column | str]) -> DataFrame:
    """One catalog row per input row; labels that are not given are ''."""
    return labelled(df, {label: values.get(label, DOMAIN_TYPE if label == "Domain Type" else "") for label in LABELS})


def described_columns(columns: DataFrame, classification: DataFrame, pipelines: DataFrame, environment: str) -> DataFrame:
    """Columns of active, published pipelines with their classification and location, one row per column."""
    active = active_published(pipelines).select(
        "pipeline_id",
        "pipeline_desc",
        community_name("domain_name").alias("domain_name"),
        F.concat_ws("", "target_file_name", "target_table_name").alias("table_name"),
        storage_location("target_environments", environment).alias("location"),
    )
    classes = classification.select("column_id", "classification_level", "business_description")
    joined = columns.join(classes, "column_id", "left").join(active, "pipeline_id")
    described = joined.select(
        "domain_name",
        "table_name",
        "target_column_name",
        F.lower("target_datatype").alias("datatype"),
        F.coalesce(F.col("target_length").cast("string"), F.lit("0")).alias("target_length"),
        F.col("target_precision").cast("string").alias("target_precision"),
        "target_datetime_format",
        F.coalesce("classification_level", F.lit(DEFAULT_CLASSIFICATION)).alias("classification_level"),
        "business_description",
        "pipeline_desc",
        "location",
        "column_id",
    )
    return distinct_on(described, ["domain_name", "table_name", "target_column_name"], ["column_id"])


def raw_feed(columns: DataFrame, classification: DataFrame, pipelines: DataFrame, environment: str) -> DataFrame:
    """Table rows, then column rows, of the raw zone. Duplicate columns keep the one with the lowest id."""
    described = cut(described_columns(columns, classification, pipelines, environment))
    tables = described.select("domain_name", "table_name", "pipeline_desc", "location").distinct()
    table_rows = catalog_rows(
        tables,
        {
            "Full Name": F.col("table_name"),
            "Name": F.col("table_name"),
            "Community": F.col("domain_name"),
            "Domain": "Raw",
            "Asset Type": "Table",
            "File Location": F.concat_ws("/", "location", "table_name"),
            "Description": F.col("pipeline_desc"),
        },
    )
    path = F.concat_ws(" > ", "target_column_name", "table_name")
    column_rows = catalog_rows(
        described,
        {
            "Full Name": path,
            "Name": F.col("target_column_name"),
            "Community": F.col("domain_name"),
            "Domain": "Raw",
            "Asset Type": "Column",
            "Data Type": catalog_type_name("datatype", RAW_TYPE_NAMES),
            "Data Type Precision": F.col("target_precision"),
            "Size": F.col("target_length"),
            "Data Classification": F.col("classification_level"),
            "Format": F.col("target_datetime_format"),
            "Description": F.col("business_description"),
            "is part of [Table] > Name": F.col("table_name"),
            "is part of [Table] > Full Name": path,
            "is part of [Table] > Community": F.col("domain_name"),
            "is part of [Table] > Domain": "Raw",
        },
    )
    return table_rows.union(column_rows)


def processed_feed(lineage: DataFrame) -> DataFrame:
    """Table rows and column rows of the processed zone, from the final records of all scripts and domains."""
    final = lineage.filter(F.col("transformation_func_nm") == FINAL).select(
        community_name("domain_name").alias("domain_name"), "final_df_cols", "target_tables", "final_path"
    )
    table_rows = catalog_rows(
        final,
        {
            "Full Name": F.lower("target_tables"),
            "Name": F.lower("target_tables"),
            "Community": F.col("domain_name"),
            "Domain": "Processed",
            "Asset Type": "Table",
            "File Location": F.col("final_path"),
        },
    )
    # A column is described as "('name', 'type')"; a type may hold a comma of its own.
    exploded = final.select("domain_name", "target_tables", F.explode("final_df_cols").alias("described"))
    pattern = r"^\('([^']*)', '([^']*)'\)$"
    columns = exploded.select(
        "domain_name",
        "target_tables",
        F.regexp_extract("described", pattern, 1).alias("col_name"),
        F.regexp_extract("described", pattern, 2).alias("col_type"),
    )
    is_decimal = F.col("col_type").startswith("decimal")
    plain_type = F.when(is_decimal, F.lit("decimal")).otherwise(F.col("col_type"))
    column_rows = catalog_rows(
        columns,
        {
            "Full Name": F.concat_ws(" > ", F.lower("col_name"), "target_tables"),
            "Name": F.lower("col_name"),
            "Community": F.col("domain_name"),
            "Domain": "Processed",
            "Asset Type": "Column",
            "Data Type": catalog_type_name(plain_type, PROCESSED_TYPE_NAMES),
            "Data Type Precision": decimal_part("col_type", 2),
            "Size": F.coalesce(decimal_part("col_type", 1), F.lit("")),
            "is part of [Table] > Name": F.col("target_tables"),
            "is part of [Table] > Full Name": F.concat_ws(" > ", "col_name", "target_tables"),
            "is part of [Table] > Community": F.col("domain_name"),
            "is part of [Table] > Domain": "Processed",
        },
    )
    return table_rows.union(column_rows)


def dataset_columns(datasets: dict[str, DataFrame]) -> DataFrame:
    """Each dataset's column list as JSON. Only schemas are looked at, no data."""
    spark = next(iter(datasets.values())).sparkSession
    rows = [
        (name, position, field.name, field.dataType.simpleString())
        for name, df in datasets.items()
        for position, field in enumerate(df.schema.fields)
    ]
    listed = spark.createDataFrame(rows, "dataset string, position int, column_name string, column_type string")
    ordered = F.array_sort(F.collect_list(F.struct("position", "column_name", "column_type")))
    pairs = F.transform(ordered, lambda c: F.struct(c["column_name"].alias("column_name"), c["column_type"].alias("column_type")))
    return listed.groupBy("dataset").agg(F.to_json(pairs).alias("columns"))
