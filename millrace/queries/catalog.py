"""Catalog feeds and lineage. `part` plays the column inventory, its brands the pipelines, `supplier` the classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans import catalog, lineage, pipelines
from millrace.queries import Tables, register
from millrace.queries.projections import TYPE_NAMES

TYPE_LIST_SQL = (
    "['bigint', 'smallint', 'string', 'timestamp', 'datetime', 'date', 'varchar', 'double', 'decimal(10,2)']"
)
CATALOG_LIST_SQL = (
    "['Whole Number', 'Whole Number', 'Text', 'Date Time', 'Date Time', 'Date', 'Text', 'Decimal Number', 'Decimal Number(10,2)']"
)
DOMAINS = ["esg", "finance", "ratings", "other"]
COMMUNITY_LIST_SQL = "['DataLake_ESG', 'DataLake_Finance', 'DataLake_Ratings', 'other']"


def picked(values: list[str], index) -> F.Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def brand_number():
    return F.substring("p_brand", 7, 3).cast("int")


def environments():
    """A JSON list of two environments, as an inventory row holds it."""
    entry = '{{"environment_name": "{}", "target_bucket_name": "{}'
    return F.concat(
        F.lit("[" + entry.format("DEV", "dev-")), "p_brand", F.lit('"}, ' + entry.format("PRD", "prd-")), "p_brand", F.lit('"}]')
    )


def pipeline_table(t: Tables):
    brands = t.part.select("p_brand").distinct()
    return brands.select(
        F.col("p_brand").alias("pipeline_id"),
        F.concat(F.lit("about "), "p_brand").alias("pipeline_desc"),
        picked(DOMAINS, brand_number() % 4).alias("domain_name"),
        F.lit("file_").alias("target_file_name"),
        F.col("p_brand").alias("target_table_name"),
        environments().alias("target_environments"),
        F.when(F.col("p_brand") == "Brand#3", F.lit("false")).otherwise(F.lit("true")).alias("active"),
        F.lit("published").alias("status"),
    )


def column_table(t: Tables):
    return t.part.select(
        F.col("p_partkey").alias("column_id"),
        F.col("p_brand").alias("pipeline_id"),
        F.col("p_name").alias("target_column_name"),
        F.upper(picked(TYPE_NAMES, F.col("p_size") % 9)).alias("target_datatype"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_size")).alias("target_length"),
        F.lit(None).cast("int").alias("target_precision"),
        F.lit(None).cast("string").alias("target_datetime_format"),
    )


def classification_table(t: Tables):
    return t.supplier.select(
        F.col("s_suppkey").alias("column_id"),
        F.lit("SECRET").alias("classification_level"),
        F.col("s_name").alias("business_description"),
    )


@register(
    "WITH j AS (SELECT p.*, s_name, CASE WHEN s_suppkey IS NULL THEN 'INTERNAL' ELSE 'SECRET' END AS level, "
    f"{COMMUNITY_LIST_SQL}[CAST(substring(p_brand, 7, 3) AS INTEGER) % 4 + 1] AS community, 'file_' || p_brand AS tbl "
    "FROM part p LEFT JOIN supplier ON s_suppkey = p_partkey WHERE p_brand <> 'Brand#3'), "
    "c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY community, tbl, p_name ORDER BY p_partkey) rn FROM j) WHERE rn = 1), "
    "tables AS (SELECT DISTINCT tbl, community, p_brand FROM c) "
    "SELECT tbl AS \"Full Name\", tbl AS \"Name\", community AS \"Community\", 'Physical Data Dictionary' AS \"Domain Type\", 'Raw' AS \"Domain\", "
    "'Table' AS \"Asset Type\", '' AS \"Data Type\", '' AS \"Data Type Precision\", '' AS \"Size\", '' AS \"Data Classification\", "
    "'s3://prd-' || p_brand || '/data/final/' || tbl AS \"File Location\", '' AS \"Format\", 'about ' || p_brand AS \"Description\", "
    "'' AS \"is part of [Table] > Name\", '' AS \"is part of [Table] > Full Name\", '' AS \"is part of [Table] > Community\", "
    "'' AS \"is part of [Table] > Domain\" FROM tables UNION ALL "
    f"SELECT p_name || ' > ' || tbl, p_name, community, 'Physical Data Dictionary', 'Raw', 'Column', {CATALOG_LIST_SQL}[p_size % 9 + 1], "
    "NULL, CASE WHEN p_type = 'ECONOMY' THEN '0' ELSE CAST(p_size AS VARCHAR) END, level, '', NULL, s_name, tbl, "
    "p_name || ' > ' || tbl, community, 'Raw' FROM c"
)
def catalog_raw_feed(t: Tables):
    return catalog.raw_feed(column_table(t), classification_table(t), pipeline_table(t), "prd")


@register(
    f"WITH v AS (SELECT *, {COMMUNITY_LIST_SQL}[CAST(substring(p_brand, 7, 3) AS INTEGER) % 4 + 1] AS community, "
    "'TBL_' || p_partkey AS tbl FROM part) "
    "SELECT lower(tbl) AS \"Full Name\", lower(tbl) AS \"Name\", community AS \"Community\", 'Physical Data Dictionary' AS \"Domain Type\", "
    "'Processed' AS \"Domain\", 'Table' AS \"Asset Type\", '' AS \"Data Type\", '' AS \"Data Type Precision\", '' AS \"Size\", "
    "'' AS \"Data Classification\", '/final/' || tbl AS \"File Location\", '' AS \"Format\", '' AS \"Description\", "
    "'' AS \"is part of [Table] > Name\", '' AS \"is part of [Table] > Full Name\", '' AS \"is part of [Table] > Community\", "
    "'' AS \"is part of [Table] > Domain\" FROM v UNION ALL "
    "SELECT lower(p_type) || ' > ' || tbl, lower(p_type), community, 'Physical Data Dictionary', 'Processed', 'Column', "
    "'Decimal Number', '2', '10', '', '', '', '', tbl, p_type || ' > ' || tbl, community, 'Processed' FROM v UNION ALL "
    "SELECT 'amount > ' || tbl, 'amount', community, 'Physical Data Dictionary', 'Processed', 'Column', "
    "'Whole Number', NULL, '', '', '', '', '', tbl, 'amount > ' || tbl, community, 'Processed' FROM v"
)
def catalog_processed_feed(t: Tables):
    target = F.concat(F.lit("TBL_"), F.col("p_partkey").cast("string"))
    records = t.part.select(
        picked(DOMAINS, brand_number() % 4).alias("domain_name"),
        F.lit(lineage.FINAL).alias("transformation_func_nm"),
        F.array(
            F.concat(F.lit("('"), "p_type", F.lit("', 'decimal(10,2)')")), F.lit("('amount', 'bigint')")
        ).alias("final_df_cols"),
        target.alias("target_tables"),
        F.concat(F.lit("/final/"), target).alias("final_path"),
    )
    return catalog.processed_feed(records)


@register("SELECT p_partkey, 's3://prd-' || p_brand || '/data/final' AS location FROM part")
def storage_location(t: Tables):
    return t.part.select("p_partkey", pipelines.storage_location(environments(), "prd").alias("location"))


def supply_edges(t: Tables):
    """part -> supplier -> nation -> region, as edges of a graph."""

    def node(kind: str, name: str):
        return F.concat(F.lit(f"{kind}:"), F.col(name).cast("string"))

    parts = t.lineitem.select(node("part", "l_partkey").alias("source"), node("supplier", "l_suppkey").alias("target"))
    suppliers = t.supplier.select(node("supplier", "s_suppkey").alias("source"), node("nation", "s_nationkey").alias("target"))
    nations = t.nation.select(node("nation", "n_nationkey").alias("source"), node("region", "n_regionkey").alias("target"))
    return parts.union(suppliers).union(nations)


@register(
    "SELECT DISTINCT 'region:' || n_regionkey AS target, 'part:' || l_partkey AS source FROM lineitem "
    "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey "
    "UNION SELECT 'region:' || n_regionkey, 'supplier:' || s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey "
    "WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey) "
    "UNION SELECT 'region:' || n_regionkey, 'nation:' || n_nationkey FROM nation "
    "WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey)"
)
def lineage_closure(t: Tables):
    targets = t.region.select(F.concat(F.lit("region:"), F.col("r_regionkey").cast("string")).alias("target"))
    return lineage.root_sources(supply_edges(t), targets)


@register("SELECT o_orderpriority AS script_name, o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW'")
def lineage_forget(t: Tables):
    records = t.orders.select(F.col("o_orderpriority").alias("script_name"), "o_orderkey")
    return lineage.forget_script(records, "5-LOW")
