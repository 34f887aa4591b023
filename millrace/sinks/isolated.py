"""Writing to a target that refuses single rows: tasks halve a refused batch until the bad rows stand alone.

A sink (see `FolderSink`, `DatabaseSink`) takes batches of rows and raises if it refuses any of them; what it says about a
batch need not tell which row was meant. The writing tasks find that out in logarithmic steps, without the driver, and report
what they have kept and what was refused. When all tasks are done, their work is published, or discarded as a whole.
"""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import closing
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from millrace.operators.cdc import unique_keys, upsert
from millrace.session import discard_at_exit, scratch_path
from millrace.sinks.commits import read_text
from millrace.sinks.files import write_final
from millrace.sources.files import read_target

BATCH = 1000
ERROR = "error_message"
DONE = "outcome.json"


def isolate(batch: pa.RecordBatch, apply: Callable[[pa.RecordBatch], None]) -> Iterator[tuple[int, str]]:
    """Apply a batch, halving what is refused; (row number, message) of each row that is refused alone. Parts are applied in
    order. A bad row costs two calls for each halving at most."""
    waiting = [(0, batch.num_rows)]
    while waiting:
        first, size = waiting.pop()
        if not size:
            continue
        try:
            apply(batch.slice(first, size))
        except Exception as error:  # noqa: BLE001 - what a sink refuses is data
            if size == 1:
                yield first, f"{type(error).__name__}: {error}"
            else:
                half = size // 2
                waiting += [(first + half, size - half), (first, half)]


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if path.startswith("file:") or "://" in path else (fs.LocalFileSystem(), path)


class _ParquetFile:
    """A file that is opened when the first rows come."""

    def __init__(self, folder: str, kind: str):
        self.path = f"{folder}/{kind}/{uuid.uuid4().hex}.parquet"
        self.writer: pq.ParquetWriter | None = None

    def write(self, batch: pa.RecordBatch) -> None:
        if self.writer is None:
            system, path = _place(self.path)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            self.writer = pq.ParquetWriter(path, batch.schema, filesystem=system)
        self.writer.write_batch(batch)

    def close(self) -> str | None:
        """The path, or None if nothing was written."""
        if self.writer is None:
            return None
        self.writer.close()
        return self.path


class _FolderSession:
    def __init__(self, sink: FolderSink):
        self.check, self.file = sink.check, _ParquetFile(sink.folder, "kept")

    def apply(self, batch: pa.RecordBatch) -> None:
        self.check(batch)
        self.file.write(batch)

    def keep(self) -> str | None:
        return self.file.close()

    def close(self) -> None:
        self.file.close()


@dataclass
class FolderSink:
    """Keeps rows as Parquet files in a shared folder; `check` raises if a batch holds a row that the target would refuse."""

    folder: str
    check: Callable[[pa.RecordBatch], None]

    def open(self) -> _FolderSession:
        return _FolderSession(self)

    def publish(self, receipts: Sequence[str]) -> None:
        """Nothing to do: whoever reads the outcome reads the files of the receipts."""

    def discard(self, receipts: Sequence[str]) -> None:
        for receipt in receipts:
            system, path = _place(receipt)
            system.delete_file(path)


class _DatabaseSession:
    def __init__(self, sink: DatabaseSink):
        self.sink, self.connection, self.rows = sink, sink.connect(), 0
        self.cursor = self.connection.cursor()

    def apply(self, batch: pa.RecordBatch) -> None:
        self.cursor.execute("SAVEPOINT batch")
        try:
            self.cursor.executemany(self.sink.stage, [tuple(r.values()) for r in batch.to_pylist()])
        except Exception:
            self.cursor.execute("ROLLBACK TO SAVEPOINT batch")
            raise
        finally:
            self.cursor.execute("RELEASE SAVEPOINT batch")
        self.rows += batch.num_rows

    def keep(self) -> str | None:
        self.connection.commit()
        return str(self.rows)

    def close(self) -> None:
        self.connection.close()


@dataclass
class DatabaseSink:
    """Rows go to a staging table with the target's constraints, by the statement `stage`, each task in a transaction of its own.
    `merge` statements bring all of it into the target in one transaction; `clear` statements empty the staging table.
    `connect` gives a DB-API connection. A task that is repeated stages its rows again, so `stage` has to be an upsert."""

    connect: Callable
    stage: str
    merge: Sequence[str]
    clear: Sequence[str]

    def open(self) -> _DatabaseSession:
        return _DatabaseSession(self)

    def _run(self, statements: Sequence[str]) -> None:
        with closing(self.connect()) as connection:
            cursor = connection.cursor()
            for statement in statements:
                cursor.execute(statement)
            connection.commit()

    def publish(self, receipts: Sequence[str]) -> None:
        self._run([*self.merge, *self.clear])

    def discard(self, receipts: Sequence[str]) -> None:
        self._run(self.clear)


@dataclass
class _Report(WriterCommitMessage):
    kept: str | None
    rows: int
    refused: int
    refused_file: str | None


class _Writer(DataSourceArrowWriter):
    def __init__(self, sink, folder: str, batch: int, all_or_nothing: bool):
        self.sink, self.folder, self.batch, self.all_or_nothing = sink, folder, batch, all_or_nothing

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Report:
        rows = refused = 0
        bad = _ParquetFile(self.folder, "refused")
        with closing(self.sink.open()) as session:
            for whole in iterator:
                for first in range(0, whole.num_rows, self.batch):
                    part = whole.slice(first, self.batch)
                    alone = list(isolate(part, session.apply))
                    if alone:
                        places, messages = zip(*alone)
                        named = part.take(pa.array(places)).append_column(ERROR, pa.array(messages, pa.string()))
                        bad.write(named)
                    rows, refused = rows + part.num_rows - len(alone), refused + len(alone)
            return _Report(session.keep(), rows, refused, bad.close())

    def commit(self, messages: list[_Report | None]) -> None:
        done = [m for m in messages if m is not None]
        kept = [m.kept for m in done if m.kept is not None]
        good = not (self.all_or_nothing and any(m.refused for m in done))
        (self.sink.publish if good else self.sink.discard)(kept)
        outcome = {
            "published": good, "kept": kept if good else [], "rows": sum(m.rows for m in done), "refused": sum(m.refused for m in done),
            "refused_files": [m.refused_file for m in done if m.refused_file],
        }
        system, path = _place(self.folder)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{DONE}") as out:
            out.write(json.dumps(outcome).encode())

    def abort(self, messages: list[_Report | None]) -> None:
        self.sink.discard([m.kept for m in messages if m is not None and m.kept is not None])


class IsolatedRows(DataSource):
    """A write-only source; its options are made by `write_isolated`."""

    @classmethod
    def name(cls) -> str:
        return "isolated_rows"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        sink = cloudpickle.loads(base64.b64decode(self.options["sink"]))
        return _Writer(sink, self.options["folder"], int(self.options["batch"]), self.options["all_or_nothing"] == "true")


@dataclass
class Outcome:
    """Whether rows were published, how many were good and refused, the files of a folder sink, and the refused rows with what
    was said about them (None if there are none)."""

    published: bool
    rows: int
    refused: int
    kept: list[str]
    refused_rows: DataFrame | None


def write_isolated(df: DataFrame, sink, folder: str, batch: int = BATCH, all_or_nothing: bool = True) -> Outcome:
    """Write rows to a sink in batches; `folder` (shared by all executors) gets the refused rows and the outcome.

    With `all_or_nothing` a single refused row discards everything, as one transaction would; else good rows are published.
    A lost or repeated task counts once: only what its last attempt reports is published.
    """
    spark = df.sparkSession
    spark.dataSource.register(IsolatedRows)
    options = {
        "sink": base64.b64encode(cloudpickle.dumps(sink)).decode(), "folder": folder, "batch": batch, "all_or_nothing": all_or_nothing,
    }
    df.write.format("isolated_rows").options(**options).mode("append").save()
    found = json.loads(read_text(spark, f"{folder}/{DONE}"))
    bad = spark.read.parquet(*found["refused_files"]) if found["refused_files"] else None
    return Outcome(found["published"], found["rows"], found["refused"], found["kept"], bad)


def upsert_isolated(
    incoming: DataFrame,
    path: str,
    keys: str | Sequence[str],
    check: Callable[[pa.RecordBatch], None],
    all_or_nothing: bool = True,
    batch: int = BATCH,
    newest_by: Sequence[str] = (),
) -> Outcome:
    """Upsert rows into a file table that refuses what `check` raises for. The table changes by one commit, or not at all; keys
    that come several times among the good rows are resolved by `newest_by` or are an error."""
    spark: SparkSession = incoming.sparkSession
    folder = scratch_path(spark, "isolated")
    discard_at_exit(spark, folder)
    outcome = write_isolated(incoming, FolderSink(folder, check), folder, batch, all_or_nothing)
    if outcome.published and outcome.kept:
        good = unique_keys(spark.read.schema(incoming.schema).parquet(*outcome.kept), keys, newest_by)
        write_final(upsert(read_target(spark, path), good, keys), path)
    return outcome


def refused_messages(outcome: Outcome) -> DataFrame | None:
    """message and rows: how often each thing was said."""
    if outcome.refused_rows is None:
        return None
    return outcome.refused_rows.groupBy(ERROR).agg(F.count(F.lit(1)).alias("rows"))
