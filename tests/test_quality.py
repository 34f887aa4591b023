import json
from datetime import datetime

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.operators.quality import Constraint, Rule, Run


@pytest.fixture
def data(frame):
    return frame(
        [(1, "a", 5, 1), (2, "b", 50, 60), (2, None, None, 1), (3, "c", 7, None)], "id int, s string, x int, y int"
    )


def rule(kind, columns, values=(), **more):
    return Rule(f"r_{kind}", kind, tuple(columns), ("id",), tuple(values), **more)


RULES = [
    rule("not_null", ["s"]), rule("in_set", ["s"], ["a", "b"]), rule("between", ["x"], [0, 10]),
    rule("greater_pair", ["x", "y"]), rule("unique", ["id"]), rule("equal_pair", ["x", "x"]),
]


def test_error_rows(data):
    errors = quality.error_rows(quality.rule_scan(data, RULES), RULES, Run("run", "2024-01-01"))
    assert errors.columns == [*quality.ERROR_COLUMNS, "run_dt"]
    found = sorted((r["rule_id"], json.loads(r["primary_keys"])["id"]) for r in errors.collect())
    assert found == [
        ("r_between", 2), ("r_greater_pair", 2), ("r_in_set", 3), ("r_not_null", 2), ("r_unique", 2), ("r_unique", 2),
    ]
    assert {r["run_dt"] for r in errors.collect()} == {"2024-01-01"}


def test_row_rules_share_one_scan(data, spark, tmp_path):
    data.write.parquet(str(tmp_path / "t"))
    errors = quality.error_rows(spark.read.parquet(str(tmp_path / "t")), RULES[:4], Run("run"))
    plan = plan_of(errors)
    assert plan.count("Scan parquet") == 2 or plan.count("(1) Scan parquet") == 1
    assert "Exchange" not in plan


def test_summary(data):
    found = {r["rule_id"]: (r["checked"], r["failing"], r["success"]) for r in quality.rule_summary(data, RULES).collect()}
    assert found["r_not_null"] == (4, 1, False)
    assert found["r_unique"] == (4, 2, False)
    assert found["r_equal_pair"] == (4, 0, True)


def test_nulls_are_not_duplicates(frame):
    data = frame([(1, None), (2, None), (3, "x"), (4, "x")], "id int, u string")
    unique = rule("unique", ["u"])
    assert rows(quality.failing_rows(data, unique)) == [(3, "x"), (4, "x")]
    assert quality.rule_summary(data, [unique]).first()["failing"] == 2


def test_rule_arguments():
    bad = [rule("between", ["x"], [1]), rule("in_set", ["s"]), rule("greater_pair", ["x"]), rule("not_null", ["s"], [1]), rule("other", ["s"])]
    for one in bad:
        assert quality.rule_problems(one)
        with pytest.raises(ValueError):
            quality.require_valid([one])
    assert quality.require_valid([rule("other", ["s"], active=False)]) == []


def test_rules_from_inventory():
    record = {"rule_id": "7", "rule_name": "value range", "column": "x", "user_values": "1, 10", "key_columns": "id,s", "table_name": "t", "active_flag": "true"}
    made = Rule.from_record(record, {"value range": "between"})
    assert made.values == (1, 10) and made.key_columns == ("id", "s") and made.active
    pair = Rule.from_record({**record, "rule_name": "more", "user_values": "y"}, {"more": "greater_pair"})
    assert pair.columns == ("x", "y") and pair.values == ()
    chosen = Rule.from_record({**record, "rule_name": "one of", "user_values": "'a', 2,c"}, {"one of": "in_set"})
    assert chosen.values == ("a", 2, "c")
    idle = Rule.from_record({**record, "active_flag": "false"}, {"value range": "between"})
    assert list(quality.group_rules([made, idle, made])) == [("", "t", "")]
    assert len(quality.group_rules([made, idle, made])[("", "t", "")]) == 2


def test_run_log(spark):
    moment = datetime(2024, 1, 1)
    log = quality.run_log(spark, [("run", "r", moment, moment, "SUCCESS", "")])
    assert log.count() == 1 and log.columns[0] == "execution_id"


def test_verify(data):
    checks = [
        Constraint("isComplete", "id"), Constraint("isComplete", "s"), Constraint("hasCompleteness", "s", 0.7),
        Constraint("isUnique", "id"), Constraint("isUnique", "y"), Constraint("isNonNegative", "x"),
        Constraint("isContainedIn", "s", ["a", "b"]), Constraint("hasDataType", "s", "Integral"),
    ]
    found = {r["constraint"]: r["status"] for r in quality.verify(data, checks).collect()}
    assert found == {
        "isComplete(id)": "Success", "isComplete(s)": "Failure", "hasCompleteness(s, 0.7)": "Success",
        "isUnique(id)": "Failure", "isUnique(y)": "Failure", "isNonNegative(x)": "Success",
        "isContainedIn(s, ['a', 'b'])": "Failure", "hasDataType(s, Integral)": "Failure",
    }
    message = quality.verify(data, [Constraint("isComplete", "s")]).first()
    assert message["value"] == 0.75 and "0.75" in message["message"]
    with pytest.raises(ValueError):
        quality.verify(data, [Constraint("dropTable", "s")])
    assert quality.verify(data.filter("id > 9"), checks).filter("status = 'Failure'").count() == 0


def test_batch_collects_failures(data):
    tables = {"good": data, "bad": data}
    found, failures = quality.verify_tables(tables, {"good": [Constraint("isComplete", "id")], "bad": [Constraint("absent", "id")]})
    assert found.count() == 1 and list(failures) == ["bad"]


def test_suggestions(spark):
    data = spark.range(1000).select(
        "id", (F.col("id") - 5).alias("signed"), F.when(F.col("id") % 2 == 0, "x").alias("half"),
        F.col("id").cast("string").alias("digits"), F.lit("k").alias("k"), F.lit(None).cast("string").alias("never"),
    )
    found = {(r["column_name"], r["suggestion"]): r["dq_rule"] for r in quality.suggest(quality.profile(data)).collect()}
    assert found[("half", "completeness")] == 'hasCompleteness("half", 0.46)'
    assert {("id", "complete"), ("id", "unique"), ("id", "non-negative"), ("digits", "type")} <= set(found)
    assert ("signed", "non-negative") not in found and ("k", "unique") not in found
    assert not [key for key in found if key[0] == "never"]
    suggestions, results = quality.suggest_or_verify(data, [Constraint("isComplete", "id")])
    assert suggestions is None and results.count() == 1


def test_keys(frame):
    child = frame([(1,), (1,), (9,), (None,)], "fk int")
    parent = frame([(1,), (2,)], "k int")
    assert rows(quality.orphans(child, parent, "fk", "k")) == [(9,)]
    assert rows(quality.primary_key_violations(child, "fk")) == [(1, 2), (None, 1)]


def test_run_logs_what_cannot_run(spark, data):
    from millrace.plans.quality_run import run_rules

    rules = [Rule("a", "not_null", ("s",), ("id",), table_name="t"), Rule("b", "between", ("x",), ("id",), table_name="t")]
    errors, summary, log = run_rules(spark, rules, {"t": data}, Run("run"))
    assert errors.count() == 1 and summary.first()["rule_id"] == "a"
    assert {r["rule_id"]: r["execution_status"] for r in log.collect()} == {"b": "FAILED"}  # what ran is logged by write_run


def test_written_run_counts_on_the_way(spark, data, tmp_path):
    from millrace.plans.quality_run import write_run

    path = str(tmp_path / "errors")
    more = [rule("not_null", ["s"], table_name="t"), rule("between", ["x"], [0, 10], table_name="t"), rule("unique", ["id"], table_name="t"), Rule("lost", "not_null", ("s",), ("id",), table_name="absent")]
    summary, log = write_run(spark, more, {"t": data}, Run("run.1", "2024-01-01"), path)
    assert rows(summary) == [("r_between", 4, 1, False), ("r_not_null", 4, 1, False), ("r_unique", 4, 2, False)]
    assert {r["rule_id"]: r["execution_status"] for r in log.collect()}["lost"] == "FAILED"
    written = spark.read.parquet(path)
    assert written.count() == 4 and written.first()["execution_id"] == "run1"


def test_value_lists(spark):
    k = F.col("id")
    data = spark.range(1000).select(
        F.when(k % 100 < 95, "a").when(k % 100 < 99, "b").alias("few"),
        F.when(k < 950, (k % 3).cast("string")).otherwise(F.concat(F.lit('o"'), k.cast("string"))).alias("tail"),
        F.concat(F.lit("v"), (k % 200).cast("string")).alias("many"), k.cast("string").alias("digits"), F.lit(None).cast("string").alias("never"),
    )
    profiled = quality.profile(data, categories=True)
    lists = {r["column_name"]: r["categories"] for r in profiled.collect()}
    assert [tuple(x) for x in lists["few"]] == [("a", 950), ("b", 40)] and len(lists["tail"]) == 53
    assert lists["many"] is None and lists["digits"] is None and lists["never"] == []
    found = {(r["column_name"], r["suggestion"]): r["dq_rule"] for r in quality.suggest(profiled).collect()}
    assert found[("few", "categories")] == 'isContainedIn("few", ["a", "b"])'
    assert found[("few", "most categories")] == 'isContainedIn("few", ["a"], 0.94)'
    assert ("tail", "categories") not in found and ("tail", "most categories") not in found  # most values come once
    assert not [k for k in found if k[1].endswith("categories") and k[0] != "few"]
    stored, _ = quality.suggest_or_verify(data, [])
    assert stored.filter("dq_rule LIKE 'isContainedIn%'").count() == 0
