"""Best-fit packing in levels: partitions pack their own pieces, and what is left underfull is packed again in a tree.

1. Each task encodes its documents, cuts the longer ones, and packs the pieces it has by best fit, largest first. Bins
   that are nearly full are final.
2. Underfull bins are items of the next round, as large as what they hold. Rounds pack groups of bounded size by best fit;
   the groups of a round are fewer than those of the round before. A bin that has less room than the smallest one holds can take
   nothing any more and is final.

Only (bin, fill) rows travel in the rounds. Pieces stay where the first level wrote them and learn the sequence of their bin
in one join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.encoding import by_size, encoder, groups_by_size
from millrace.session import cut

CAPACITY = 2048
SLACK = 4  # tokens that a nearly full bin may lack
WINDOW = 1 << 16  # pieces that a task packs at a time
GROUP = 20_000  # bins that a task merges at a time
LEAST_GAIN = 0.001  # rounds end when they save a smaller share of the bins
_PIECE = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
_PLACE = [("bin", pa.int64()), ("offset", pa.int64()), ("fill", pa.int32())]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill int"
BINS = "root long, fill int, parts array<struct<bin: long, shift: long>>"


def best_fit(sizes: Sequence[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each size, in the order given, and what each bin holds. Each size goes to the fullest bin that can
    take it, else to a new one; open bins stand by their room, and a bit mask tells the least room that is enough."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, fills = [], [], []
    rooms = 0
    for size in sizes:
        enough = rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            stack = by_room[room]
            here = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            here, room = len(fills), capacity
            fills.append(0)
        bins.append(here)
        offsets.append(capacity - room)
        room -= size
        fills[here] = capacity - room
        if room:
            by_room[room].append(here)
            rooms |= 1 << room
    return bins, offsets, fills


def cuts(size: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: only longer ones are cut, and the first piece takes the remainder."""
    first = (size - 1) % capacity + 1
    return [(0, first), *((start, capacity) for start in range(first, size, capacity))]


def _packed(rows: list[tuple], first_bin: int, capacity: int, slack: int) -> tuple[pa.RecordBatch, int]:
    """A batch of the pieces with their bins, numbered from `first_bin`, and the next free number. `fill` stands at the first
    piece of a bin that is not nearly full."""
    columns = [np.array(c) for c in zip(*[(r[1], r[2], r[3], r[4]) for r in rows])]
    order = np.argsort(-columns[2], kind="stable")
    bins, offsets, fills = best_fit(columns[2][order].tolist(), capacity)
    bins, offsets, fills = np.array(bins), np.array(offsets), np.array(fills)
    held = fills[bins]
    open_first = (offsets == 0) & (held < capacity - slack)
    docs = pa.array([rows[k][0] for k in order.tolist()], pa.int64())
    arrays = [docs, *(pa.array(c[order], kind) for c, (_, kind) in zip(columns, _PIECE[1:]))]
    arrays += [pa.array(bins + first_bin, pa.int64()), pa.array(offsets, pa.int64()), pa.array(held, pa.int32(), mask=~open_first)]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(_PIECE + _PLACE)), first_bin + len(fills)


def local_bins(
    docs: DataFrame, tokenizer: str, blank: str, lower: bool, end_id: int, capacity: int = CAPACITY, slack: int = SLACK, window: int = WINDOW
) -> DataFrame:
    """First level: pieces of `docs` (doc_id, text) with the bin and the offset that their task gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, end = encoder(tokenizer, blank, lower), np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 33
        waiting: list[tuple] = []
        for batch in by_size(batches):
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for group in groups_by_size(texts):
                for name, ids in zip(names[group], encode_texts(texts[group])):
                    data = memoryview(ids + end)
                    for k, (start, size) in enumerate(cuts(len(data) // 4, capacity)):
                        waiting.append((name, k, start, size, zlib.crc32(data[4 * start : 4 * (start + size)])))
                if len(waiting) >= window:
                    out, number = _packed(waiting, number, capacity, slack)
                    waiting = []
                    yield out
        if waiting:
            yield _packed(waiting, number, capacity, slack)[0]

    return docs.mapInArrow(run, PIECES)


def _round(bins: DataFrame, groups: int, turn: int, capacity: int) -> DataFrame:
    """Best fit of bins as items, in `groups` groups."""
    kind = pa.list_(pa.struct([("bin", pa.int64()), ("shift", pa.int64())]))

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("fill", "descending"), ("root", "ascending")])
        places, offsets, fills = best_fit(rows["fill"].to_pylist(), capacity)
        roots: list[int] = [0] * len(fills)
        parts: list[list[dict]] = [[] for _ in fills]
        for root, held, place, offset in zip(rows["root"].to_pylist(), rows["parts"].to_pylist(), places, offsets):
            if not offset:
                roots[place] = root
            parts[place] += [{"bin": p["bin"], "shift": p["shift"] + offset} for p in held]
        return pa.table({"root": pa.array(roots, pa.int64()), "fill": pa.array(fills, pa.int32()), "parts": pa.array(parts, kind)})

    key = F.pmod(F.xxhash64("root", F.lit(turn)), F.lit(groups)).alias("group")
    return bins.groupBy(key).applyInArrow(merge, BINS)


def merged_bins(bins: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, group: int = GROUP) -> DataFrame:
    """bin, sequence_id and shift of underfull bins (bin, fill): rounds of best fit until nothing can be merged, one group
    has been packed whole, or a round saves less than LEAST_GAIN of the bins."""
    own = F.array(F.struct(F.col("bin"), F.lit(0).cast("long").alias("shift")))
    rest = cut(bins.select(F.col("bin").alias("root"), "fill", own.alias("parts")))
    done = []
    turn = 0
    while True:
        n, least = rest.agg(F.count("*"), F.min("fill")).first()
        room = F.col("fill") < capacity - slack
        mergeable = room & (F.col("fill") + F.lit(least) <= capacity)
        live = rest.where(mergeable).count() if n else 0
        if live < 2:
            break
        done.append(rest.where(~mergeable))
        groups = -(-live // group)
        rest = cut(_round(rest.where(mergeable), groups, turn, capacity))
        turn += 1
        if groups == 1 or live - rest.count() < LEAST_GAIN * live:
            break
    done.append(rest)
    found = done[0]
    for other in done[1:]:
        found = found.unionByName(other)
    parts = found.select("root", F.explode("parts").alias("p"))
    return parts.select(F.col("p.bin").alias("bin"), F.col("root").alias("sequence_id"), F.col("p.shift").alias("shift"))


def pack(
    docs: DataFrame,
    tokenizer: str,
    blank: str,
    lower: bool,
    end_id: int,
    capacity: int = CAPACITY,
    slack: int = SLACK,
    window: int = WINDOW,
    group: int = GROUP,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece (from 0), start, length and ids_crc32 of its ids, sequence_id, offset there.

    Each document is its ids and `end_id`; only longer ones than `capacity` are cut, into pieces of `capacity` ids of which
    the first may be shorter. Null and empty texts are one end id. Null ids stay null; repeated rows are packed one by one;
    an empty table gives no rows; other columns are not read. Ties of size keep the order of the rows in their task, so a
    repeated task packs alike. A task holds `window` pieces (some 100 bytes each), a merging task about `group` bins.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    pieces = cut(local_bins(rows, tokenizer, blank, lower, end_id, capacity, slack, window))
    merged = merged_bins(pieces.where(F.col("fill").isNotNull()).select("bin", "fill"), capacity, slack, group)
    moved = cut(merged.where(F.col("bin") != F.col("sequence_id")))
    placed = pieces.join(moved, "bin", "left")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("sequence_id", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )
