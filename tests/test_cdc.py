import pytest
from conftest import plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import cdc


@pytest.fixture
def target(frame):
    return frame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k int, v string")


def test_indicator(target, frame):
    feed = frame(
        [(1, "A", "UPD", 1), (2, None, "DEL", 2), (3, "C", None, 3), (4, "d", "INS", 4), (5, "e", "UPD", 5), (None, "m", "INS", 6)],
        "k int, v string, op string, rno int",
    )
    merged = cdc.merge(target, feed, ["k"], indicator="op")
    assert merged.columns == ["k", "v"]
    assert rows(merged) == [(1, "A"), (3, "c"), (4, "d"), (5, "e"), (None, "m"), (None, "n")]


def test_unknown_indicator_removes(target, frame):
    feed = frame([(1, "A", "???")], "k int, v string, op string")
    assert rows(cdc.merge(target, feed, ["k"], indicator="op")) == [(2, "b"), (3, "c"), (None, "n")]


def test_upsert_and_literal(target, frame):
    incoming = frame([(1, "A"), (2, "b"), (9, "z")], "k int, v string")
    assert rows(cdc.merge(target, incoming, ["k"])) == [(1, "A"), (2, "b"), (3, "c"), (9, "z"), (None, "n")]
    assert rows(cdc.merge(target, incoming, ["k"], literal=True)) == [
        (1, "A"), (1, "a"), (2, "b"), (3, "c"), (9, "z"), (None, "n"),
    ]


def test_other_merges(target, frame):
    incoming = frame([(1, "A")], "k int, v string")
    assert rows(cdc.merge(None, incoming, ["k"])) == [(1, "A")]
    assert cdc.merge(target, incoming).count() == 5
    assert rows(cdc.merge(target, incoming, ["k"], partition_column="d")) == [(1, "A")]
    assert rows(cdc.full_load(target, incoming)) == [(1, "A")]
    stamped = cdc.current_version_merge(target, incoming, ["k"], "2024-01-01 00:00:00")
    assert stamped.count() == 4 and stamped.filter("etl_insert_ts is null").count() == 0
    again = cdc.current_version_merge(stamped, incoming, ["k"], "2024-01-02 00:00:00")
    assert again.columns == ["k", "v", "etl_insert_ts"]


def test_range_gives_the_same_rows(target, frame, spark, tmp_path):
    for keys in ([2], [1, 3], [9], []):
        incoming = frame([(k, "new") for k in keys], "k int, v string")
        assert rows(cdc.upsert(target, incoming, "k", by_range=True)) == rows(cdc.upsert(target, incoming, "k"))
        feed = incoming.withColumn("op", F.lit("DEL"))
        assert rows(cdc.merge_by_indicator(target, feed, "k", "op", True)) == rows(cdc.merge_by_indicator(target, feed, "k", "op"))
    texts = frame([("a", "b"), ("c", "d"), (None, "e")], "k string, v string")
    assert rows(cdc.upsert(texts, frame([("c", "x")], "k string, v string"), "k", by_range=True)) == [("a", "b"), ("c", "x"), (None, "e")]


def test_range_reaches_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", F.lit("v").alias("v")).write.parquet(path)
    merged = cdc.upsert(spark.read.parquet(path), spark.range(90, 95).select("id", F.lit("w").alias("v")), "id", by_range=True)
    plan = plan_of(merged)
    assert "GreaterThanOrEqual(id,90)" in plan and "LessThan(id,90)" in plan
    assert merged.count() == 100 and merged.filter("v = 'w'").count() == 5


def test_empty_increment_changes_nothing(target):
    nothing = target.limit(0)
    assert rows(cdc.upsert(target, nothing, ["k"])) == rows(target)
    feed = nothing.withColumn("op", F.lit("UPD"))
    assert rows(cdc.merge_by_indicator(target, feed, ["k"], "op")) == rows(target)


def test_upsert_is_idempotent(target, frame):
    incoming = frame([(1, "A"), (9, "z")], "k int, v string")
    once = cdc.upsert(target, incoming, ["k"])
    assert rows(cdc.upsert(once, incoming, ["k"])) == rows(once)


def test_unique_keys(frame):
    repeated = frame([(1, "a", 1), (1, "b", 2), (None, "x", 1), (None, "y", 1)], "k int, v string, o int")
    with pytest.raises(ValueError):
        cdc.require_unique_keys(repeated, "k")
    assert rows(cdc.newest_per_key(repeated, "k", ["o"])) == [(1, "b", 2), (None, "x", 1), (None, "y", 1)]
    assert cdc.require_unique_keys(repeated.filter("o = 2"), "k").count() == 1


def test_newest_keeps_equal_keyless_rows_and_one_of_equal_newest(frame):
    repeated = frame([(1, "a", 1), (1, "a", 1), (1, "b", 1), (None, "x", 1), (None, "x", 1)], "k int, v string, o int")
    found = cdc.newest_per_key(repeated, "k", ["o"])
    assert found.filter("k = 1").count() == 1 and rows(found.filter("k is null")) == [(None, "x", 1)] * 2
    assert rows(found) == rows(cdc.newest_per_key(repeated.repartition(5), "k", ["o"]))
    assert plan_of(found).count("WindowGroupLimit") >= 2


def test_rejects(target, frame):
    incoming = frame([(1, "A"), (2, None)], "k int, v string")
    valid = F.col("v").isNotNull()
    same, rejected = cdc.upsert_or_reject(target, incoming, ["k"], valid)
    assert rows(same) == rows(target) and rows(rejected) == [(2, None)]
    merged, rejected = cdc.upsert_or_reject(target, incoming, ["k"], valid, all_or_nothing=False)
    assert rows(merged) == [(1, "A"), (2, "b"), (3, "c"), (None, "n")] and rejected.count() == 1


def test_daily_windows(spark, frame):
    windows = cdc.daily_windows(spark, "2024-01-01 06:00:00", "2024-01-03 12:00:00")
    assert [str(r["window_start"]) for r in windows.orderBy("day").collect()] == [
        "2024-01-01 06:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00",
    ]
    assert str(windows.orderBy(F.desc("day")).first()["window_end"]) == "2024-01-03 12:00:00"
    times = frame([("2024-01-01 05:00:00",), ("2024-01-01 07:00:00",), ("2024-01-03 12:00:00",)], "t string")
    found = cdc.rows_per_window(times.select(F.col("t").cast("timestamp_ntz").alias("t")), "t", windows)
    assert [r["row_count"] for r in found.orderBy("day").collect()] == [1, 0, 1]


changes = st.lists(
    st.tuples(st.integers(0, 6), st.sampled_from("xyz"), st.sampled_from(["UPD", "INS", "DEL", None])),
    max_size=6, unique_by=lambda c: c[0],
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=st.dictionaries(st.integers(0, 6), st.sampled_from("ab"), max_size=6), feed=changes)
def test_indicator_merge_against_a_dictionary(spark, old, feed):
    expected = dict(old)
    for key, value, op in feed:
        if op == "DEL":
            expected.pop(key, None)
        elif op is not None:
            expected[key] = value
    target = spark.createDataFrame(list(old.items()), "k int, v string")
    incoming = spark.createDataFrame(feed, "k int, v string, op string")
    assert rows(cdc.merge_by_indicator(target, incoming, ["k"], "op")) == sorted(expected.items(), key=repr)


def test_repeated_keys_in_an_increment(frame):
    target = frame([(1, "a", 1), (2, "b", 1)], "k int, v string, t int")
    twice = frame([(1, "x", 2), (1, "y", 3), (None, "n", 1), (None, "m", 1)], "k int, v string, t int")
    assert rows(cdc.merge(target, twice, ["k"], newest_by=["t"])) == [(1, "y", 3), (2, "b", 1), (None, "m", 1), (None, "n", 1)]
    with pytest.raises(ValueError, match="repeated key"):
        cdc.merge(target, twice, ["k"])
    with pytest.raises(ValueError, match="repeated key"):
        cdc.merge(None, twice, ["k"])


def test_a_feed_can_be_merged_into_its_first_load(frame):
    feed = frame([(1, "a", "INS"), (2, "b", "DEL"), (3, "c", None)], "k int, v string, op string")
    first = cdc.merge(None, feed, ["k"], indicator="op")
    assert first.columns == ["k", "v"] and rows(first) == [(1, "a"), (3, "c")]
    second = frame([(1, "A", "UPD"), (3, "c", "DEL")], "k int, v string, op string")
    assert rows(cdc.merge(first, second, ["k"], indicator="op")) == [(1, "A")]


def test_windows_reach_the_scan(spark, tmp_path):
    spark.range(10).select(F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("ts")).write.parquet(str(tmp_path / "t"))
    data = spark.read.parquet(str(tmp_path / "t"))
    found = cdc.rows_by_window(data, "ts", cdc.daily_windows(spark, "1970-01-03 00:00:00", "1970-01-05 12:00:00"))
    assert found.count() == 3 and "GreaterThanOrEqual(ts" in plan_of(found)
