from datetime import datetime

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from millrace.operators import filters


def test_incremental_window_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(
        "id", (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("a"),
        F.lit(None).cast("timestamp_ntz").alias("b"), F.lit("wide").alias("c"),
    ).write.parquet(path)
    data = spark.read.parquet(path)
    found = filters.incremental_window(data, ["a", "b"], "2024-01-03 00:00:00", datetime(2024, 1, 5), ["id"])
    assert rows(found) == [(2,), (3,), (4,)]
    plan = plan_of(found)
    assert "PushedFilters: [Or(" in plan and "c:string" not in plan
    everything = filters.incremental_window(data, ["a"], None, "2030-01-01 00:00:00")
    assert everything.count() == 100
    assert filters.incremental_window(data, [], None, "2030-01-01 00:00:00").count() == 100


def test_windowed_query():
    query = "select * from t where d between '{}' and '{}'"
    assert filters.windowed_query(query, "a", "b", "full") == "select * from t where d between 'a' and 'b'"
    assert filters.windowed_query(query, None, "b", "full") == "full"
    assert filters.windowed_query("select 1", None, "b", "full") == "select 1"


def test_simple_filters(frame):
    data = frame([("true", "published", "UPD"), ("true", "draft", "DEL"), ("false", "published", None)], "active string, status string, op string")
    assert filters.active_published(data).count() == 1
    assert rows(filters.change_types(data, "op", ["UPD", "INS"]).select("op")) == [("UPD",)]
    assert filters.equal_or_all(data, "op", "").count() == 3
    assert filters.equal_or_all(data, "op", "UPD").count() == 1
    assert filters.select_rows(data, "op is null").count() == 1
    assert filters.select_rows(data, lambda s, o: s == "draft" and o == "DEL", "status", "op").count() == 1
    with pytest.raises(ValueError):
        filters.select_rows(data, lambda s: True)


def test_contains_any_cuts_before_distinct(frame):
    data = frame([("x" * 100 + "1",), ("x" * 100 + "2",), ("GDP real",), ("CPI",), (None,)], "n string")
    assert filters.contains_any(data, "n", ["x"], length=100).count() == 1
    assert rows(filters.contains_any(data, "n", ["GDP", "CPI", "real"])) == [("CPI",), ("GDP real",)]
    assert filters.contains_any(data, "n").count() == 5


def test_exact_lookup_ignores_trailing_blanks(frame):
    data = frame([("GDP ", 1), ("GDP", 2), (" GDP", 3)], "n string, i int")
    assert rows(filters.lookup_exact(data, "n", "GDP", "i")) == [(1,), (2,)]


def test_sla(frame):
    data = frame([("00:01:00", 59.0), ("00:01:00", 60.0), ("", 1.0), (None, 1.0)], "s string, e double")
    found = [r[0] for r in data.select(filters.sla_met("s", "e")).collect()]
    assert found == ["true", "false", "not applicable", "not applicable"]
