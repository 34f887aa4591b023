"""Token ids in flat binary files: a shard has `.ids` (flat unsigned integers), `.offsets` (64-bit positions in the whole
collection, one more than documents) and `.docs` (64-bit document ids).

Documents lie in ascending order of (doc_id, hash of the text), shards in the same order. A first job range-partitions,
encodes and writes ids and lengths, a second adds each shard's base, a prefix sum over shards, to its offsets. Tasks write
under a name of their own attempt and rename, so repeated or speculative attempts leave one whole file.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.encoding import by_size, encoder, groups_by_size
from millrace.session import cut

NO_DOC = -(1 << 63)
SHARD = "shard int, n_docs long, n_tokens long"


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


class _Writer:
    """A file that appears under its name only when complete."""

    def __init__(self, folder: str, name: str):
        self.fs, root = _place(folder)
        self.fs.create_dir(root, recursive=True)
        self.path, self.part = f"{root}/{name}", f"{root}/.{name}-{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.part)

    def write(self, data) -> None:
        self.out.write(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def _mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """The numbers of a file: memory-mapped where the folder is a local or mounted one, else read."""
    files, root = _place(folder)
    path = f"{root}/{name}"
    if files.get_file_info(path).size == 0:
        return np.zeros(0, kind)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with files.open_input_file(path) as source:
        return np.frombuffer(source.readall(), kind)


def _one_task_each(shards: DataFrame) -> DataFrame:
    """Spread the few bytes that describe shards, which Spark would put into one task by their size."""
    return shards.repartitionByRange(max(1, shards.count()), "shard")


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    blank: str,
    lower: bool,
    end_id: int,
    kind: str = "<u4",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode whole texts, write the files below `folder` (shared by all executors) and return one row per shard.

    `kind` is the numpy type of the ids; `<u2` holds vocabularies up to 65,536. Each document ends with `end_id`. Null
    texts are empty ones; rows without an id come first and are stored as the smallest 64-bit integer; repeated ids are
    ordered by a hash of the text, so equal rows are the only ties. An empty table gives no shards. Further columns are
    not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, shard = encoder(tokenizer, blank, lower), TaskContext.get().partitionId()
        end, most = np.array([end_id], "<u4").tobytes(), np.iinfo(kind).max
        ids = lengths = None
        n_docs = n_tokens = 0
        for batch in by_size(batches):
            if ids is None:
                ids, lengths, docs_out = (_Writer(folder, f"{shard:06d}.{x}") for x in ("ids", "lengths", "docs"))
            texts = batch.column("text").to_pylist()
            docs_out.write(np.array([NO_DOC if d is None else d for d in batch.column("doc_id").to_pylist()], "<i8").tobytes())
            for group in groups_by_size(texts):
                found = [x + end for x in encode_texts(texts[group])]
                numbers = np.frombuffer(b"".join(found), "<u4")
                if numbers.size and numbers.max() > most:
                    raise ValueError(f"ids up to {numbers.max()} do not fit {kind}")
                ids.write(numbers.astype(kind).tobytes())
                sizes = np.array([len(x) // 4 for x in found], "<i8")
                lengths.write(sizes.tobytes())
                n_docs, n_tokens = n_docs + len(sizes), n_tokens + int(sizes.sum())
        if ids is not None:
            for out in (ids, lengths, docs_out):
                out.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "n_docs": pa.array([n_docs], pa.int64()), "n_tokens": pa.array([n_tokens], pa.int64())}
            )

    shards = cut(ordered.mapInArrow(encode, SHARD))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    based = shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = _mapped(folder, f"{row['shard']:06d}.lengths", "<i8")
                offsets = np.zeros(len(lengths) + 1, "<i8")
                np.cumsum(lengths, out=offsets[1:])
                out = _Writer(folder, f"{row['shard']:06d}.offsets")
                out.write((offsets + row["base"]).tobytes())
                out.close()
            yield batch

    return cut(_one_task_each(based).mapInArrow(place, f"{SHARD}, base long"))


def read_tokens(shards: DataFrame, folder: str, kind: str = "<u4", with_ids: bool = True) -> DataFrame:
    """Documents from the files: doc_id, start (ids before it in the whole collection), n_tokens, ids_crc32 over
    little-endian unsigned 32-bit ids, and the ids themselves with `with_ids`."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{row['shard']:06d}"
                ids, offsets = _mapped(folder, f"{name}.ids", kind), _mapped(folder, f"{name}.offsets", "<i8")
                docs = _mapped(folder, f"{name}.docs", "<i8")
                yield from _rows(docs, offsets, ids)

    def _rows(docs: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        base = int(offsets[0])
        for first in range(0, len(docs), 1024):
            cuts = offsets[first : first + 1025]
            parts = [ids[a - base : b - base] for a, b in zip(cuts[:-1], cuts[1:])]
            here = np.array(docs[first : first + 1024])
            columns = {
                "doc_id": pa.array(here, pa.int64(), mask=here == NO_DOC),
                "start": pa.array(np.array(cuts[:-1]), pa.int64()),
                "n_tokens": pa.array(np.diff(cuts), pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([p.astype("i8") for p in parts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return _one_task_each(shards).mapInArrow(read, schema)


def tokens_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one, deleted when the application ends."""
    from millrace.session import discard_at_exit, scratch_path

    path = scratch_path(spark, "tokens")
    discard_at_exit(spark, path)
    return path if "://" in path or path.startswith("file:") else os.path.abspath(path)
