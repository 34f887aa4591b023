"""Rows that a target refuses, against a check of every row."""

import math
import sys

import pyarrow as pa
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from millrace.sinks import isolated
from millrace.sinks import files as sinks
from millrace.sources.files import read_target


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not know the tests


def no_negatives(batch):
    if any(v is not None and v < 0 for v in batch.column("v").to_pylist()):
        raise ValueError("negative")


@given(st.lists(st.booleans(), max_size=70))
@settings(max_examples=150, deadline=None)
def test_bad_rows_are_found_in_logarithmic_steps(good):
    batch = pa.RecordBatch.from_pydict({"k": list(range(len(good))), "v": [1 if g else -1 for g in good]})
    calls, kept = 0, []

    def apply(part):
        nonlocal calls
        calls += 1
        no_negatives(part)
        kept.extend(part.column("k").to_pylist())

    refused = list(isolated.isolate(batch, apply))
    assert [k for k, _ in refused] == [k for k, g in enumerate(good) if not g] and all(m == "ValueError: negative" for _, m in refused)
    assert kept == [k for k, g in enumerate(good) if g]
    assert calls <= 1 + 2 * len(refused) * (math.ceil(math.log2(len(good))) if len(good) > 1 else 0)


@pytest.mark.parametrize("batch", [1, 7, 1000])
@pytest.mark.parametrize("all_or_nothing", [True, False])
def test_upsert(spark, tmp_path, batch, all_or_nothing):
    path = str(tmp_path / "t")
    sinks.write_final(spark.range(100).selectExpr("id AS k", "0L AS v"), path)
    incoming = spark.range(50, 300).selectExpr("id AS k", "CASE WHEN id % 41 = 0 THEN -1L ELSE id END AS v").repartition(3)
    outcome = isolated.upsert_isolated(incoming, path, "k", no_negatives, all_or_nothing, batch)
    bad = [k for k in range(50, 300) if k % 41 == 0]
    assert (outcome.published, outcome.rows, outcome.refused) == (not all_or_nothing, 250 - len(bad), len(bad))
    assert sorted(r["k"] for r in outcome.refused_rows.collect()) == bad
    assert rows(isolated.refused_messages(outcome)) == [("ValueError: negative", len(bad))]
    want = {k: 0 for k in range(100)}
    if not all_or_nothing:
        want |= {k: k for k in range(50, 300) if k not in bad}
    assert dict(r for r in rows(read_target(spark, path))) == want


def test_nothing_refused_nothing_given_and_repeated_keys(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    outcome = isolated.upsert_isolated(frame([(1, 5), (None, None)], "k long, v long"), path, "k", no_negatives)
    assert outcome.published and outcome.refused_rows is None and isolated.refused_messages(outcome) is None
    isolated.upsert_isolated(frame([], "k long, v long"), path, "k", no_negatives)
    assert rows(read_target(spark, path)) == [(1, 5), (None, None)]
    with pytest.raises(ValueError, match="repeated key"):
        isolated.upsert_isolated(frame([(1, 5), (1, 6)], "k long, v long"), path, "k", no_negatives)
    isolated.upsert_isolated(frame([(1, 5), (1, 6)], "k long, v long"), path, "k", no_negatives, newest_by=["v"])
    assert rows(read_target(spark, path)) == [(1, 6), (None, None)]


def test_a_lost_run_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_final(spark.range(3).selectExpr("id AS k", "id AS v"), path)
    broken = spark.range(10).selectExpr("id AS k", "CASE WHEN id = 9 THEN raise_error('lost') ELSE id END AS v")
    with pytest.raises(Exception, match="lost"):
        isolated.upsert_isolated(broken, path, "k", no_negatives)
    assert rows(read_target(spark, path)) == [(0, 0), (1, 1), (2, 2)]


class Connection:
    """A database of one staging table, as the interface of drivers has it."""

    def __init__(self):
        self.log, self.rows, self.saved = [], [], []

    def cursor(self):
        return self

    def execute(self, text):
        self.log.append(text)
        if text.startswith("SAVEPOINT"):
            self.saved = list(self.rows)
        elif text.startswith("ROLLBACK"):
            self.rows = self.saved

    def executemany(self, text, values):
        for value in values:
            self.rows.append(value)
            if value[1] < 0:
                raise RuntimeError("check constraint")

    def commit(self):
        self.log.append("commit")

    def close(self):
        self.log.append("close")


def test_database_session_rolls_back_to_the_batch():
    connection = Connection()
    sink = isolated.DatabaseSink(lambda: connection, "upsert", ["merge"], ["clear"])
    session = sink.open()
    batch = pa.RecordBatch.from_pydict({"k": [1, 2, 3, 4], "v": [1, -1, 3, 4]})
    assert list(isolated.isolate(batch, session.apply)) == [(1, "RuntimeError: check constraint")]
    assert connection.rows == [(1, 1), (3, 3), (4, 4)] and session.keep() == "3"
    sink.publish(["3"])
    sink.discard(["3"])
    assert connection.log[-8:] == ["commit", "merge", "clear", "commit", "close", "clear", "commit", "close"]
