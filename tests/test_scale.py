"""Plans and hot keys: what must hold whatever the size of the tables."""

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace import queries as registry  # noqa: E402
from millrace.operators import aggregate, cdc, joins, quality, sets, windows
from millrace.plans import methodology
from millrace.queries import methodology as queries
from millrace.sources import jdbc

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def small_splits(spark):
    """Make adaptive execution treat test-sized partitions as it would treat large ones."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=60000):
    """A table in which one key holds a third of the rows."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k")
    return spark.range(0, n, numPartitions=8).select(key, F.sha2(F.col("id").cast("string"), 256).alias("v"))


def run(df):
    df.write.format("noop").mode("overwrite").save()
    executed = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    query = df._jdf.queryExecution()
    df.collect()
    return query.explainString(executed)


def test_hot_left_keys_are_split(small_splits):
    big, keys = hot(small_splits), small_splits.range(0, 60000, 2).select(F.col("id").alias("k"), F.col("id").alias("w"))
    for found in (joins.anti_join(big, keys, "k"), joins.semi_join(big, keys, "k"), joins.left_join(big, keys, "k"), joins.join(big, keys, "k")):
        assert "SortMergeJoin(skew=true)" in run(found)


def test_hot_right_keys_are_split(small_splits):
    big, keys = hot(small_splits), small_splits.range(0, 60000, 2).select(F.col("id").alias("k"), F.col("id").alias("w"))
    for found in (joins.left_join(keys, big, "k", hot_right_keys=True), joins.outer_join(keys, big, "k")):
        assert "SortMergeJoin(skew=true)" in run(found)
    plain = keys.join(big, "k", "left")
    assert rows(joins.left_join(keys, big, "k", hot_right_keys=True)) == rows(plain.select("k", "w", "v"))


def test_hot_keys_give_whole_results(small_splits):
    big = hot(small_splits, 30000)
    assert windows.latest_rows(big, "k", "v").count() == 20001
    assert cdc.upsert(big, big.filter("k = 0").limit(1), "k").count() == 20001
    unique = quality.Rule("u", "unique", ("k",), ("v",))
    assert quality.failing_rows(big, unique).count() == 10000
    assert sets.complement(big.select("k"), big.filter("k > 0").select("k")).count() == 1
    parts = aggregate.group_to_json_array(big, "k", ["v"], ["v"], rows_per_part=1000)
    assert parts.filter("k = 0").count() == 10


def test_hot_group_numbers_do_not_meet_in_one_task(spark):
    big = hot(spark)
    placed = big.repartitionByRange(8, "k", "v")
    largest = placed.filter("k = 0").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 15000


def test_hot_sort_key_spreads(small_splits):
    from millrace.operators.sort import sort

    placed = sort(hot(small_splits), "k").withColumn("p", F.spark_partition_id())
    largest = placed.filter("k = 0").groupBy("p").count().agg(F.max("count")).first()[0]
    assert largest < 15000


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_code_tables_do_not_gather_rows_in_a_task_for_each_code(spark):
    def codes(prefix):
        """Two codes, found among rows that look too many to broadcast."""
        found = spark.range(3_000_000).select(F.when(F.col("id") % 2 == 0, F.lit("O")).otherwise(F.lit("F")).alias("v")).distinct()
        return found.select(F.concat(F.lit("C-"), "v").alias(f"{prefix}_cd"), F.col("v").alias(f"{prefix}_desc"))

    t = registry.Tables(spark, FOLDER)
    consultations, requests = queries.consultations(t), queries.numbered_requests(t)
    joined = {
        "rfc": methodology.comment_requests(consultations, codes("rfc_status")),
        "roc": methodology.consultation_results(consultations, requests, codes("roc_status")),
        "doc": methodology.methodology_documents(queries.documents(t), queries.methodology_table(t), codes("meth_doc_status")),
        "meth": methodology.methodologies(queries.documents(t), codes("meth_typ"), None),
    }
    plans = {k: plan_of(df) for k, df in joined.items()}
    shuffled = [line for plan in plans.values() for line in plan.splitlines() if "hashpartitioning" in line]
    assert not [line for line in shuffled if "status" in line or "type_code" in line]
    assert plans["rfc"].count("BroadcastHashJoin") >= 1 and "SortMergeJoin" not in plans["rfc"]
    assert joined["rfc"].count() == t.lineitem.count()


def test_increments_are_found_once(spark):
    """The merge reads an increment for its keys and for its rows; the window that picks its rows must not run for both."""
    assert "Window" not in plan_of(registry.QUERIES["cdc_newest_valid"](spark, FOLDER))


def test_later_loads_find_their_rows_once(spark):
    t = registry.Tables(spark, FOLDER)
    codes = queries.lookup(t.lineitem, "l_linestatus", "roc_status")
    known = spark.createDataFrame([], "rfc_id long, roc_publcn_nm string, roc_cms_doc_id string, roc_rmc_doc_id string, roc_publcn_dtm date, roc_status_cd string, modified_dtm timestamp_ntz, modified_user_id string")
    loaded = methodology.load_consultation_results(queries.consultations(t), queries.numbered_requests(t), codes, known, "2024-03-01 00:00:00", "u")
    assert "Window" not in plan_of(loaded) and "l_shipdate" not in plan_of(loaded)


def test_links_are_reduced_once_at_the_end(spark):
    links = spark.range(1000).select((F.col("id") % 10).alias("l"), (F.col("id") % 7).alias("r"))
    left, right = links.select("l").distinct(), links.select("r").distinct()
    found = joins.bridge(links, left, right, "l", "r")
    assert found.count() == 70
    stored = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select(F.col("l_partkey").alias("l"), F.col("l_suppkey").alias("r"))
    plan = optimized(joins.bridge(stored, left, right, "l", "r")).splitlines()
    at = next(k for k, line in enumerate(plan) if "Relation" in line)
    join = max(k for k in range(at) if "Join" in plan[k])
    assert not [line for line in plan[join:at] if "Aggregate" in line]


def test_bounds_by_rank_sort_values_and_not_rows(spark):
    data = spark.range(1000).select(F.when(F.col("id") % 9 > 0, F.col("id") % 5 * F.col("id") % 13).alias("k"))
    for parts in (1, 2, 3, 7, 40, 2000):
        lows = [r["low"] for r in spark.sql(jdbc.bounds_by_rank_query("SELECT * FROM {data}", "k", parts), data=data).collect()]
        ranked = "SELECT MIN(k) AS low FROM (SELECT k, NTILE({}) OVER (ORDER BY k) AS part FROM {{data}} WHERE k IS NOT NULL) GROUP BY part ORDER BY low"
        assert lows == list(dict.fromkeys(r["low"] for r in spark.sql(ranked.format(parts), data=data).collect()))
    plan = optimized(spark.sql(jdbc.bounds_by_rank_query("SELECT * FROM {data}", "k", 40), data=data))
    assert plan.rindex("Window") < plan.rindex("Aggregate")  # the windows stand over counted values


PYTHON = {"computed_by_function", "converted_by_function", "conditional_by_function", "selected_by_function"}
# A window without partitions is allowed over one row per partition of an index, and nowhere else.
INDEXED = {
    "row_index", "positional_zip", "surrogate_key_lookup", "surrogate_keys_continued", "number_in_hot_groups", "pivot_concat",
    "group_to_json_array", "methodology_load", "methodology_document_load", "comment_request_load", "methodology_request_bridge",
    "pipeline_column_lists", "methodology_document_reload", "comment_request_reload", "methodology_request_load",
    "column_of_values", "pivot_in_one_row", "json_array_in_one_row",
}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_plan_grows_quadratically_or_leaves_the_jvm(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(registry.QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert ("EvalPython" in plan or "PythonUDF" in plan) == (name in PYTHON)
    if name not in INDEXED:
        assert "BroadcastHashJoin" not in plan


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(entry.queries()["weighted_average"](spark, FOLDER))
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_returnflag:string>" in plan
    window = plan_of(entry.queries()["incremental_window"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts" in window and "props" not in window
    first = plan_of(entry.queries()["lookup_join"](spark, FOLDER))
    assert "WindowGroupLimit" in first
