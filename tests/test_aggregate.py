import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import aggregate, filters, sets, sort


def test_pivots(frame):
    data = frame([("i", "x", "b"), ("i", "x", "a"), ("i", "y", "c"), ("j", "x", None), ("j", "z", "d")], "i string, c string, v string")
    found = aggregate.pivot_aggregate_data(data, "i", "c", "v", 10, ["x", "y", "z"])
    assert rows(found) == [("i", 0, "a,b", "c", ""), ("j", 0, "", "", "d")]
    parts = aggregate.pivot_aggregate_data(data, "i", "c", "v", 1, ["x", "y", "z"])
    assert rows(parts) == [("i", 0, "a", "c", ""), ("i", 1, "b", "", ""), ("j", 0, "", "", "d")]
    assert rows(aggregate.pivot_aggregate_data(data, "i", "c", "v", 10)) == rows(found)
    more = frame([("i", "x", "a"), ("k", "x", None), ("l", "w", "b")], "i string, c string, v string")
    assert rows(aggregate.pivot_aggregate_data(more, "i", "c", "v", 10, ["x"])) == [("i", 0, "a"), ("k", 0, ""), ("l", 0, "")]
    numbers = frame([("i", "x", 1), ("i", "x", 2)], "i string, c string, v int")
    assert rows(aggregate.pivot_table(numbers, "i", "c", "v", "sum", ["x", "y"])) == [("i", 3, None)]


def test_json_arrays_in_parts_are_whole(spark):
    data = spark.range(0, 1000).select(F.when(F.col("id") < 900, "hot").otherwise("cold").alias("k"), "id")
    found = aggregate.group_to_json_array(data, "k", ["id"], ["id"], rows_per_part=64).collect()
    hot = sorted((r for r in found if r["k"] == "hot"), key=lambda r: r["part"])
    assert [o["id"] for r in hot for o in json.loads(r["items"])] == list(range(900))
    assert all(len(json.loads(r["items"])) <= 64 for r in found)
    whole = aggregate.group_to_json_array(data, "k", ["id"], ["id"], 1000).filter("k = 'cold'").collect()
    assert len(whole) == 1 and len(json.loads(whole[0]["items"])) == 100


def test_json_arrays_keep_null_fields(frame):
    data = frame([("k", 1, None)], "k string, a int, b string")
    assert aggregate.group_to_json_array(data, "k", ["a", "b"], ["a"], 10).first()["items"] == '[{"a":1,"b":null}]'


def test_weighted_average(frame):
    data = frame([("g", 1.0, 1.0), ("g", None, 3.0), ("h", 2.0, 0.0)], "g string, v double, w double")
    assert rows(aggregate.weighted_average(data, "g", "v", "w", "m")) == [("g", 0.25), ("h", None)]


def test_horizon_share(frame):
    data = frame([("g", 1.0, "1998-06-01"), ("g", 3.0, "2010-01-01"), ("g", 4.0, None)], "g string, v double, d string")
    dated = data.withColumn("d", F.col("d").cast("date"))
    found = aggregate.horizon_share(dated, "g", "v", "d", "1998-01-01", [12, 24])
    assert rows(found) == [("g", 8.0, 0.125, 0.125)]
    assert rows(filters.within_horizon(dated, "d", "1998-01-01", 12).select("v")) == [(1.0,)]


def test_key_values_and_distinct(frame):
    data = frame([("a", "x", 1), ("a", "y", 2), ("b", "z", 1)], "k string, v string, o int")
    assert rows(aggregate.key_value_table(data, "k", "v", "o")) == [("a", "y"), ("b", "z")]
    assert rows(aggregate.column_values(data, "k")) == [("a",), ("b",)]
    assert rows(aggregate.distinct_on(data, "k", ["o"]).select("v")) == [("x",), ("z",)]
    assert rows(aggregate.key_bounds(data, "o")) == [(1, 2)]
    assert rows(aggregate.grouped_sum(data, "k", "o", "s")) == [("a", 3), ("b", 1)]
    assert rows(aggregate.row_counts({"d": data, "e": data.filter("o > 1")})) == [("d", 3), ("e", 1)]
    assert aggregate.remove_duplicates(data.select("k")).count() == 2


def test_sets_treat_null_as_equal(frame):
    a = frame([(1, None), (1, None), (2, "x")], "i int, t string")
    b = frame([("x", 2), ("y", 3)], "t string, i int")
    assert rows(sets.complement(a, b)) == [(1, None)]
    assert rows(sets.intersect(a, b)) == [(2, "x")]
    assert rows(sets.union_by_name(a, b)) == rows(a.unionByName(b))
    assert sets.union_by_position([a, a, a]).count() == 9


def test_equality_counts_copies(frame):
    a, b = frame([(1,), (1,)], "i int"), frame([(1,)], "i int")
    assert sets.frames_equal(a, b).first()[0] is False
    assert sets.frames_equal(a, b, "set").first()[0] is True
    sets.assert_frames_equal(a, a)
    with pytest.raises(AssertionError):
        sets.assert_frames_equal(a, b)
    with pytest.raises(ValueError):
        sets.frames_equal(a, b.withColumnRenamed("i", "j"))


def test_column_concat(frame):
    a, b = frame([("x", 1)], "k string, a int"), frame([("y", 2)], "k string, b int")
    assert rows(sets.column_concat([a, b], ["k"])) == [("x", 1, None), ("y", None, 2)]


def test_sort_latest_sample(frame, spark):
    data = frame([(1, "A"), (3, "B"), (2, "A")], "i int, s string")
    assert [r[0] for r in sort.sort(data, "i", descending=True).collect()] == [3, 2, 1]
    assert sort.latest(data, "i", "s = 'A'").first()[0] == 2
    assert sort.latest(data, "i", "s = 'C'", 0).first()[0] == 0
    many = spark.range(5000)
    sample = sort.sample_keys(many, "id", 100)
    assert sample.count() == 100 and rows(sample) == rows(sort.sample_keys(many.repartition(13), "id", 100))
    assert sort.sample_keys(data, "i", 100).count() == 3


def test_parts_in_one_row(frame):
    data = frame([("k", "c", i) for i in range(7)] + [("k", "d", 9), ("e", "x", 1)], "k string, c string, v int")
    parts = aggregate.pivot_aggregate_data(data, "k", "c", "v", 3, ["c", "d"])
    assert parts.count() > 2
    assert rows(aggregate.in_one_row(parts, "k", ["c", "d"])) == [("e", "", ""), ("k", "0,1,2,3,4,5,6", "9")]
    arrays = aggregate.group_to_json_array(data, "k", ["v"], ["v"], 3)
    found = {r["k"]: json.loads(r["items"]) for r in aggregate.in_one_row(arrays, "k", arrays=["items"]).collect()}
    assert [o["v"] for o in found["k"]] == [0, 1, 2, 3, 4, 5, 6, 9] and found["e"] == [{"v": 1}]
