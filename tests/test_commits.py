"""Targets that survive a lost driver: every run is killed at each of its steps, and the next one finds every row."""

from contextlib import contextmanager

import pytest
from conftest import rows

from millrace.operators.conform import ColumnSpec
from millrace.plans import ingest
from millrace.plans.pipelines import SUCCESS, PipelineSpec
from millrace.sinks import commits, partitions
from millrace.sinks import files as sinks
from millrace.sources.files import read_target


class Killed(BaseException):
    """Not an Exception, so that nothing on the way takes it for a failure of a run."""


@contextmanager
def killed_at(step, monkeypatch):
    """The step-th change of the file system, and all after it, do not take place."""
    done = 0
    real = commits.file_system

    class Files:
        def __init__(self, system):
            self.system = system

        def __getattr__(self, name):
            found = getattr(self.system, name)
            if name not in ("rename", "delete", "create"):
                return found

            def call(*args):
                nonlocal done
                done += 1
                if done >= step:
                    raise Killed
                return found(*args)

            return call

    def counted(spark, path):
        location, system = real(spark, path)
        return location, Files(system)

    with monkeypatch.context() as patch:
        patch.setattr(commits, "file_system", counted)
        patch.setattr(partitions, "file_system", counted)
        yield


def killed_everywhere(run, monkeypatch, check):
    """Kill `run` at its first step, its second, ... until it comes to its end; `check` after each."""
    for step in range(1, 60):
        try:
            with killed_at(step, monkeypatch):
                run(step)
            check(step, True)
            return step
        except Killed:
            check(step, False)
    raise AssertionError("the run never ended")


def test_final_table_survives_a_kill_at_each_step(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_final(spark.range(10), path)

    def run(step):
        current = read_target(spark, path)
        sinks.write_final(current.unionByName(spark.range(100 + step, 101 + step)), path)

    seen = {i: 0 for i in range(10)}

    def check(step, ended):
        found = sorted(r[0] for r in read_target(spark, path).collect())
        assert set(seen) <= set(found) and len(found) == len(set(found))
        seen.update(dict.fromkeys(found))
        assert not ended or 100 + step in seen

    assert killed_everywhere(run, monkeypatch, check) > 4
    assert [p.name for p in tmp_path.iterdir()] == ["t"]  # nothing given up stays


def test_first_load_is_whole_or_absent(spark, monkeypatch, tmp_path):
    for step in range(1, 12):
        path = str(tmp_path / f"t{step}")
        try:
            with killed_at(step, monkeypatch):
                sinks.write_final(spark.range(5), path)
        except Killed:
            found = read_target(spark, path)
            assert found is None or found.count() == 5
            sinks.write_final(spark.range(5), path)
        assert read_target(spark, path).count() == 5


def test_delta_runs_over_a_killed_one_keep_every_row(spark, frame, monkeypatch, tmp_path):
    spec = PipelineSpec("p", target_path=str(tmp_path / "f"), landing_path=str(tmp_path / "l"), load_type="delta", primary_key=("id",))
    specs = [ColumnSpec(1, "i", "id", "int"), ColumnSpec(2, "v", "v", "string")]

    def load(values):
        source = frame([(str(i), v) for i, v in values], "i string, v string")
        return ingest.run_pipeline(spark, spec, specs, source)

    load([(i, "old") for i in range(10)])

    def check(step, ended):
        load([(3, f"after {step}")])
        found = dict(rows(read_target(spark, spec.target_path)))
        assert len(found) == 10 and found[3] == f"after {step}" and found[1] in ("old", *(f"new {k}" for k in range(60)))

    killed_everywhere(lambda step: load([(1, f"new {step}")]), monkeypatch, check)


def test_increments_of_a_day_add_up_and_a_repeated_one_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    for execution, low, high in (("a", 0, 4), ("b", 4, 8), ("a", 0, 4), ("b-1", 8, 9), ("b", 4, 8)):
        sinks.append_execution(spark.range(low, high), path, "d", "2024-01-01", execution)
    sinks.append_execution(spark.range(9, 10), path, "d", "2024-01-02", "c")
    assert rows(read_target(spark, path, "d")) == [(i,) for i in range(10)]
    sinks.append_execution(spark.range(9, 10), path, "d", "2024-01-03", "c")  # repeated after midnight
    assert rows(spark.read.parquet(path).selectExpr("id", "cast(d as string)").filter("id >= 8")) == [(8, "2024-01-01"), (9, "2024-01-03")]


def test_appended_execution_survives_a_kill_at_each_step(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_execution(spark.range(3), path, "d", "2024-01-01", "first")
    sinks.append_execution(spark.range(3, 6).repartition(2), path, "d", "2024-01-01", "again")

    def check(step, ended):
        found = sorted(r[0] for r in read_target(spark, path, "d").collect())
        assert found in ([0, 1, 2, 3, 4, 5], [0, 1, 2, 13, 14]) and (not ended or found[-1] == 14)

    killed_everywhere(lambda step: sinks.append_execution(spark.range(13, 15).repartition(2), path, "d", "2024-01-01", "again"), monkeypatch, check)


def feed_runs(spark, frame, tmp_path):
    spec = PipelineSpec("p", target_path=str(tmp_path / "f"), landing_path=str(tmp_path / "l"), load_type="delta", primary_key=("id",), partition_column="d", change_indicator="op")
    specs = [ColumnSpec(1, "i", "id", "int"), ColumnSpec(2, "v", "v", "string")]

    def load(values, day, execution=None):
        source = frame([(None if i is None else str(i), v, op) for i, v, op in values], "i string, v string, op string")
        outcome = ingest.run_pipeline(spark, spec, specs, source, run_date=day, execution_id=execution).first()
        assert outcome["job_status"] == SUCCESS, outcome["error_message"]
        return outcome["final_count"]

    def table():
        read_target(spark, spec.target_path)
        return rows(spark.read.parquet(spec.target_path).selectExpr("id", "v", "cast(d as string)"))

    return load, table, spec


def test_feed_over_dated_partitions_leaves_one_row_a_key(spark, frame, tmp_path):
    load, table, spec = feed_runs(spark, frame, tmp_path)
    load([(i, "a", "INS") for i in range(4)], "2024-01-01")
    load([(i, "a", "INS") for i in range(4, 8)], "2024-01-02")
    load([(8, "a", "INS"), (9, "a", "INS"), (None, "n", "INS")], "2024-01-03")
    untouched = {p.name for p in (tmp_path / "f" / "d=2024-01-03").iterdir()}
    feed = [(0, "b", "UPD"), (1, "b", "DEL"), (5, "b", "UPD"), (2, "x", None), (10, "b", "INS"), (None, "m", "UPD")]
    want = [(0, "b"), (2, "a"), (3, "a"), (4, "a"), (5, "b"), (6, "a"), (7, "a"), (8, "a"), (9, "a"), (10, "b"), (None, "m"), (None, "n")]
    for _ in range(2):  # a repeated execution changes nothing
        assert load(feed, "2024-01-04", "again") == 4
        assert [r[:2] for r in table()] == sorted(want, key=repr)
    assert {p.name for p in (tmp_path / "f" / "d=2024-01-03").iterdir()} == untouched
    load([(0, "c", "UPD"), (10, "c", "DEL")], "2024-01-04")  # a second feed of the day
    assert [r for r in table() if r[0] in (0, 5, 10)] == [(0, "c", "2024-01-04"), (5, "b", "2024-01-04")]
    load([(i, "z", "DEL") for i in (2, 3)], "2024-01-05")  # empties a partition
    assert not (tmp_path / "f" / "d=2024-01-01").exists() and len(table()) == 9


def test_only_touched_partitions_are_read(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    for day, low in (("2024-01-01", 0), ("2024-01-02", 10), ("2024-01-03", 20)):
        sinks.append_execution(spark.range(low, low + 10), path, "d", day, day)
    touched = frame([(3,), (12,), (99,)], "id long")
    folders = partitions.touched_folders(spark, path, touched, "id", "d")
    assert folders == ["d=2024-01-01", "d=2024-01-02"]
    read = partitions._read_folders(spark, path, folders).inputFiles()
    assert {f.split("/")[-2] for f in read} == set(folders)
    sinks.append_execution(spark.range(99, 100), path, "d", "2024-01-03", "late")  # its index is out of date now
    assert partitions.touched_folders(spark, path, touched, "id", "d") == ["d=2024-01-01", "d=2024-01-02", "d=2024-01-03"]
    assert partitions.touched_folders(spark, path, touched.limit(0), "id", "d") == []
    assert spark.read.parquet(path).count() == 31  # the index is hidden


def test_feed_survives_a_kill_at_each_step(spark, frame, monkeypatch, tmp_path):
    load, table, _ = feed_runs(spark, frame, tmp_path)
    load([(i, "a", "INS") for i in range(6)], "2024-01-01")
    load([(i, "a", "INS") for i in range(6, 9)], "2024-01-02")
    feed = [(0, "b", "UPD"), (7, "b", "DEL"), (20, "b", "INS")]
    before = [(i, "a") for i in range(9)]
    after = sorted([(0, "b"), *[(i, "a") for i in (1, 2, 3, 4, 5, 6, 8)], (20, "b")], key=repr)

    def check(step, ended):
        found = [r[:2] for r in table()]
        assert found in (before, after) and (not ended or found == after)

    killed_everywhere(lambda step: load(feed, "2024-01-01", "feed"), monkeypatch, check)


def test_two_writers_are_noticed(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_final(spark.range(1), path)
    (tmp_path / "_t.commit").mkdir()
    (tmp_path / "_t.commit" / "x").write_text("")
    with pytest.raises(Exception):  # noqa: B017 - what stands there is no commit file
        sinks.write_final(spark.range(2), path)
