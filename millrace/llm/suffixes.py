"""Removal of repeated byte strings, by a distributed merge sort of suffixes that knows common prefixes.

A byte goes if it lies in a string of `length` bytes that also starts elsewhere. Sorting all suffixes of a corpus would move
each byte hundreds of times, so only anchors' suffixes are sorted: each window of `length` bytes has one anchor, its k-gram
with the smallest hash, and equal windows have equal anchors at equal places.

1. K-grams of all anchors are counted; anchors whose k-gram occurs once cannot lie in a repeated window.
2. The suffixes of the other anchors are sorted by each task, front-coded (length of the prefix shared with the one before,
   rest) and exchanged as sorted runs, one block for each key range.
3. Each range merges its runs with a loser tree whose players know their common prefix with the last winner, so no known
   prefix is compared again. Neighbours' common prefixes tell which anchors agree to the right, hashes of what stands to the
   left of an anchor tell which agree there: together, which of its windows are repeated.
4. K-grams that occur more often than `hot` would fill one range; their windows are hashed (128 bits) and counted instead.

Texts that occur more than once are compared once: all their windows are repeated.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.encoding import by_size, groups_by_size
from millrace.llm.graph import fresh_name
from millrace.session import cut

GROUP = 1 << 20
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_TABLES = np.random.default_rng(23).integers(1, 1 << 63, (3, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = (1 << 28) - 1
RECORDS_PER_RANGE = 50_000
RECORDS_PER_RUN = 50_000  # that a task sorts at a time
SAMPLES_PER_RANGE = 100
MOST_SAMPLES = 500_000  # k-grams that the driver gets at most, whatever the number of records
MOST_RANGES = 100_000


@dataclass(frozen=True)
class Settings:
    length: int = 200
    gram: int = 50
    hot: int = 20_000

    @property
    def reach(self) -> int:
        """Places an anchor can have in a window."""
        return self.length - self.gram + 1


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, np.uint64(_STEP))]))
        down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, np.uint64(_BACK))]))
    return up, down


def gram_hashes(data: np.ndarray, size: int, table: int = 0) -> np.ndarray:
    """64-bit hashes of all strings of `size` bytes."""
    n = len(data)
    if n < size:
        return np.zeros(0, np.uint64)
    up, down = _powers(max(1 << 21, 1 << int(n).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLES[table][data] * up[:n], dtype=np.uint64)])
    out = (sums[size:] - sums[:-size]) * down[: n - size + 1]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


@dataclass
class Anchors:
    """Anchors of several texts laid end to end: `place`, the first and last start of their windows, text and k-gram hash."""

    place: np.ndarray
    first: np.ndarray
    last: np.ndarray
    text: np.ndarray
    gram: np.ndarray


def anchors(data: np.ndarray, begin: np.ndarray, settings: Settings) -> Anchors:
    """`begin` has the texts' starts in `data` and its end. Ties go to the leftmost k-gram."""
    empty = np.zeros(0, np.int64)
    if len(data) < settings.length:
        return Anchors(empty, empty, empty, empty, empty.astype(np.uint64))
    grams = gram_hashes(data, settings.gram)
    keys = (grams & np.uint64(~_PLACES & (1 << 64) - 1)) | np.arange(len(grams), dtype=np.uint64)
    where = (sliding_minimum(keys, settings.reach) & np.uint64(_PLACES)).astype(np.int64)
    sizes = np.maximum(np.diff(begin) - settings.length + 1, 0)
    text = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin[:-1], sizes)
    at = where[start]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(fresh)
    tail = np.concatenate([head[1:], [len(at)]]) - 1 if len(head) else head
    return Anchors(at[head], start[head], start[tail], text[head], grams[at[head]])


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def common_prefix(x: bytes, y: bytes, known: int = 0) -> int:
    most = min(len(x), len(y))
    if x[known:most] == y[known:most]:
        return most
    step = known
    while x[step : step + 16] == y[step : step + 16]:
        step += 16
    while x[step] == y[step]:
        step += 1
    return step


def front_coded(sorted_keys: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Lengths of the prefix shared with the key before, and the rests."""
    shared = [0] * len(sorted_keys)
    for k in range(1, len(sorted_keys)):
        shared[k] = common_prefix(sorted_keys[k - 1], sorted_keys[k])
    return np.array(shared, np.uint16), [key[n:] for key, n in zip(sorted_keys, shared)]


def merge(runs: list[Iterator[tuple[int, bytes, int]]]) -> Iterator[tuple[int, bytes, int, int]]:
    """Merge front-coded sorted runs of (shared, rest, tag): yields (prefix shared with the key before, key, run, tag).

    A loser tree: each inner node keeps the loser of its match with its common prefix with the winner. Of two players the
    one that shares more with the last winner is smaller; only equal ones are compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    keys: list[bytes | None] = [None] * size
    shared, tags = [0] * size, [0] * size

    def advance(run: int) -> None:
        got = next(runs[run], None) if run < len(runs) else None
        if got is None:
            keys[run] = None
        else:
            n, rest, tags[run] = got
            keys[run] = (keys[run] or b"")[:n] + rest
            shared[run] = n

    def loser_of(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows its prefix with the winner."""
        a, b = keys[x], keys[y]
        if a is None or b is None:
            return (y, x) if a is None else (x, y)
        if shared[x] != shared[y]:
            return (x, y) if shared[x] > shared[y] else (y, x)
        n = common_prefix(a, b, shared[x])
        first, second = (x, y) if a[n:] <= b[n:] else (y, x)
        shared[second] = n
        return first, second

    for run in range(size):
        advance(run)
    losers = [0] * size
    winners = list(range(size))
    level = size
    while level > 1:
        following = []
        for k in range(0, len(winners), 2):
            first, second = loser_of(winners[k], winners[k + 1])
            losers[(level + k) // 2] = second
            following.append(first)
        winners, level = following, level // 2
    champion = winners[0]
    while keys[champion] is not None:
        yield shared[champion], keys[champion], champion, tags[champion]
        advance(champion)
        node = (size + champion) // 2
        while node:
            champion, losers[node] = loser_of(champion, losers[node])
            node //= 2


def repeated_windows(shared: np.ndarray, lefts: list[bytes], low: np.ndarray, high: np.ndarray, settings: Settings) -> np.ndarray:
    """For anchors sorted by what follows them, whether the window that begins `a` bytes before each occurs twice, shape
    (anchors, reach). `shared` are neighbours' common prefixes; anchor k's windows have a from low[k] to high[k]."""
    n = len(lefts)
    found = np.zeros((n, settings.reach), bool)
    sizes = np.array([len(x) for x in lefts])
    flat = np.frombuffer(b"".join(lefts), np.uint8)
    ends = np.cumsum(sizes)
    left = np.zeros(n, np.uint64)
    for a in range(settings.reach):
        if a:
            has = np.flatnonzero(sizes >= a)
            left[has] = (left[has] + _TABLES[2][flat[ends[has] - a]]) * np.uint64(_STEP)
            left[has] ^= left[has] >> np.uint64(31)
        here = np.flatnonzero((low <= a) & (a <= high))
        if len(here) < 2:
            continue
        right = np.cumsum(shared < settings.length - a)[here].astype(np.uint64)
        key = (left[here] ^ (right * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0xA0761D6478BD642F)
        order = np.lexsort((key, right))
        same = (key[order[1:]] == key[order[:-1]]) & (right[order[1:]] == right[order[:-1]])
        hit = np.zeros(len(here), bool)
        hit[order[1:]] |= same
        hit[order[:-1]] |= same
        found[here[hit], a] = True
    return found


def merged_spans(starts: Iterable[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs covered by windows whose starts are in the given ranges (ends included)."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(starts):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], last + length)
        else:
            out.append((first, last + length))
    return out


def without(data: bytes, spans: Iterable[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, end in spans:
        kept.append(data[at:start])
        at = end
    return b"".join([*kept, data[at:]])


def _ranges_of(flags: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and ranges of window starts of the set flags; flag a of row k is the window that starts at place[k] - a."""
    padded = np.zeros((len(flags), flags.shape[1] + 2), bool)
    padded[:, 1:-1] = flags
    row, begin = np.nonzero(padded[:, 1:] & ~padded[:, :-1])
    _, end = np.nonzero(~padded[:, 1:] & padded[:, :-1])
    return row, place[row] - (end - 1), place[row] - begin


def _records(docs: DataFrame, settings: Settings) -> DataFrame:
    """One row per anchor whose k-gram is among its text's `cold` ones, with the bytes its windows need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            texts, digests = batch.column("text").to_pylist(), batch.column("digest").to_pylist()
            wanted = batch.column("cold").to_pylist()
            for group in groups_by_size(texts, GROUP):
                parts = [(t or "").encode() for t in texts[group]]
                data, begin = _laid_out(parts)
                found = anchors(data, begin, settings)
                listed = [np.array(x or [], np.int64) for x in wanted[group]]
                # k-grams of each text, told apart by the text's number
                owner = np.repeat(np.arange(len(listed)), [len(x) for x in listed])
                pairs = set(zip(owner.tolist(), np.concatenate(listed).tolist()))
                keep = [k for k, x in enumerate(zip(found.text.tolist(), found.gram.view(np.int64).tolist())) if x in pairs]
                raw = data.tobytes()
                text, place = found.text[keep], found.place[keep]
                low, high = place - found.last[keep], place - found.first[keep]
                rights = [raw[p : p + settings.length - a] for p, a in zip(place.tolist(), low.tolist())]
                lefts = [raw[p - a : p] for p, a in zip(place.tolist(), high.tolist())]
                names = [digests[group.start + d] for d in text.tolist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "digest": pa.array(names, pa.string()), "place": pa.array(place - begin[text], pa.int64()),
                        "low": pa.array(low, pa.int32()), "high": pa.array(high, pa.int32()),
                        "lefts": pa.array(lefts, pa.binary()), "rights": pa.array(rights, pa.binary()),
                    }
                )

    return docs.mapInArrow(run, "digest string, place long, low int, high int, lefts binary, rights binary")


def _splitters(records: DataFrame, n: int, ranges: int, settings: Settings) -> list[bytes]:
    """K-grams that cut the `n` records into about equal ranges. A k-gram is never cut apart, and none of them has more than `hot`
    records, so that is all a range can have beyond its share, whatever the texts begin with. The driver gets a sample of some
    SAMPLES_PER_RANGE k-grams a range, MOST_SAMPLES in all; it only decides about balance."""
    if ranges < 2 or not n:
        return []
    every = max(1, -(-n // min(SAMPLES_PER_RANGE * ranges, MOST_SAMPLES)))
    some = records.where(F.pmod(F.xxhash64("digest", "place"), F.lit(every)) == 0)
    grams = sorted(bytes(r[0]) for r in some.select(F.substring("rights", 1, settings.gram)).toLocalIterator())
    return sorted({grams[k * len(grams) // ranges] for k in range(1, ranges)} if grams else ())


_RUN = "range int, n int, shared binary, sizes binary, rests binary, low binary, high binary, place binary, digests binary, lefts binary"


def _runs(records: DataFrame, splitters: list[bytes]) -> DataFrame:
    """Sorted front-coded runs of RECORDS_PER_RUN records at most, one row for each key range that a run meets."""
    shipped, most = records.sparkSession.sparkContext.broadcast(splitters), RECORDS_PER_RUN

    def coded(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        rights, lefts, digests = (table[c].to_pylist() for c in ("rights", "lefts", "digest"))
        low, high, place = (np.array(table[c]) for c in ("low", "high", "place"))
        order = sorted(range(len(rights)), key=rights.__getitem__)
        ends = [bisect_left(order, s, key=rights.__getitem__) for s in shipped.value]
        for where, part in enumerate(np.split(np.array(order, int), ends)):
            if not len(part):
                continue
            shared, rests = front_coded([rights[k] for k in part])
            yield pa.RecordBatch.from_pydict(
                {
                    "range": pa.array([where], pa.int32()), "n": pa.array([len(part)], pa.int32()),
                    "shared": [shared.tobytes()], "sizes": [np.array([len(x) for x in rests], np.uint16).tobytes()],
                    "rests": [b"".join(rests)], "low": [low[part].astype(np.uint16).tobytes()],
                    "high": [high[part].astype(np.uint16).tobytes()], "place": [place[part].astype(np.int64).tobytes()],
                    "digests": [b"".join(bytes.fromhex(digests[k]) for k in part)], "lefts": [b"".join(lefts[k] for k in part)],
                }
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for whole in batches:
            for first in range(0, whole.num_rows, most):
                held.append(whole.slice(first, most))
                if sum(b.num_rows for b in held) >= most:
                    yield from coded(held)
                    held = []
        if held:
            yield from coded(held)

    return records.mapInArrow(run, _RUN)


def _merged(runs: DataFrame, settings: Settings) -> DataFrame:
    """digest, first and last: ranges of starts of repeated windows, from the merged runs of each key range."""
    schema = pa.schema([("digest", pa.string()), ("first", pa.int64()), ("last", pa.int64())])

    def decoded(row: dict) -> Iterator[tuple[int, bytes, int]]:
        at = 0
        sizes = np.frombuffer(row["sizes"], np.uint16).tolist()
        for k, (n, size) in enumerate(zip(np.frombuffer(row["shared"], np.uint16).tolist(), sizes)):
            yield n, row["rests"][at : at + size], k
            at += size

    def run(key: tuple, group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        low, high, place = (
            [np.frombuffer(r[c], t).astype(np.int64) for r in rows] for c, t in (("low", np.uint16), ("high", np.uint16), ("place", np.int64))
        )
        ends = [np.concatenate([[0], np.cumsum(h)]) for h in high]
        shared, owner, tag = [], [], []
        for n, _, k, t in merge([decoded(r) for r in rows]):
            shared.append(n)
            owner.append(k)
            tag.append(t)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in low])])
        order = offsets[owner] + np.array(tag, int)
        lefts = [rows[k]["lefts"][ends[k][t] : ends[k][t + 1]] for k, t in zip(owner, tag)]
        low, high, place = (np.concatenate(x)[order] for x in (low, high, place))
        flags = repeated_windows(np.array(shared), lefts, low, high, settings)
        row, first, last = _ranges_of(flags, place)
        names = [rows[owner[k]]["digests"][16 * tag[k] : 16 * tag[k] + 16].hex() for k in row.tolist()]
        return pa.Table.from_arrays([pa.array(names, pa.string()), pa.array(first), pa.array(last)], schema=schema)

    return runs.groupBy("range").applyInArrow(run, "digest string, first long, last long")


def _hot_ranges(docs: DataFrame, settings: Settings) -> DataFrame:
    """digest, first, last of repeated windows whose anchors' k-grams are among the `hot` ones, by counting window hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            texts, digests = batch.column("text").to_pylist(), batch.column("digest").to_pylist()
            for text, digest, hot in zip(texts, digests, batch.column("hot").to_pylist()):
                data, begin = _laid_out([(text or "").encode()])
                found = anchors(data, begin, settings)
                keep = np.flatnonzero(np.isin(found.gram.view(np.int64), np.array(hot or [], np.int64)))
                starts = [np.arange(a, b + 1) for a, b in zip(found.first[keep], found.last[keep])]
                start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
                h = [gram_hashes(data, settings.length, k)[start].view(np.int64) for k in (0, 1)] if len(start) else [start, start]
                names = pa.array([digest] * len(start), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(start), *map(pa.array, h)], names=["digest", "first", "h1", "h2"])

    windows = cut(docs.where(F.size("hot") > 0).mapInArrow(run, "digest string, first long, h1 long, h2 long"))
    twice = windows.groupBy("h1", "h2").count().where("count > 1").select("h1", "h2")
    return windows.join(twice, ["h1", "h2"]).select("digest", "first", F.col("first").alias("last"))


def _measured(docs: DataFrame, settings: Settings) -> DataFrame:
    """Of each row: id, digest, size, sha256 and the k-gram hashes of its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            texts = batch.column("text").to_pylist()
            for group in groups_by_size(texts, GROUP):
                parts = [t.encode() for t in texts[group]]
                data, begin = _laid_out(parts)
                found = anchors(data, begin, settings)
                cuts = np.searchsorted(found.text, np.arange(len(parts) + 1))
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(found.gram.view(np.int64)))
                here = batch.slice(group.start, len(parts))
                sums = [hashlib.sha256(p).hexdigest() for p in parts]
                sizes = pa.array([len(p) for p in parts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [here.column("doc_id"), here.column("digest"), sizes, pa.array(sums), lists], names=["doc_id", "digest", "n_bytes", "sha", "grams"]
                )

    return docs.mapInArrow(run, "doc_id long, digest string, n_bytes long, sha string, grams array<long>")


def repeated_spans(docs: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, digest (md5 of the text), n_bytes, spans (array of start and end bytes, in order),
    n_removed, n_spans and kept_sha256 (of the bytes outside spans).

    Null texts are empty ones; texts shorter than `length` have no spans; a text that occurs again is one span if it is as
    long. Null ids stay null, repeated rows are documents of their own that repeat each other, an empty table gives no rows,
    other columns are not read.
    """
    no_id = F.lit(-(1 << 63))
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("long"), no_id).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    ).withColumn("digest", F.md5("text"))
    measured = _measured(rows, settings)
    sizes = cut(measured)
    once = cut(
        sizes.groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.min("n_bytes").alias("n_bytes"), F.first("grams").alias("grams")
        )
    )
    # 64 bits of the digest name a text here; two texts of one name only get each other's hints
    name = F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")
    places = once.select(name.alias("name"), F.explode("grams").alias("gram"))
    often = cut(places.groupBy("gram").agg(F.count("*").alias("times")).where("times > 1"))  # apart, so that hot k-grams can be split
    hints = places.join(often, "gram").groupBy("name").agg(
        F.collect_set(F.when(F.col("times") <= settings.hot, F.col("gram"))).alias("cold"),
        F.collect_set(F.when(F.col("times") > settings.hot, F.col("gram"))).alias("hot"),
    )
    chosen = once.select(name.alias("name"), "digest", "doc_id", "copies").join(hints, "name").drop("name")
    texts = cut(rows.join(chosen, ["digest", "doc_id"]).select("digest", "text", "copies", "cold", "hot"))

    records = cut(_records(texts.where(F.size("cold") > 0), settings))
    n = records.count()
    ranges = max(1, min(-(-n // RECORDS_PER_RANGE), MOST_RANGES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) if n > 1000 else 1)
    found = _merged(_runs(records, _splitters(records, n, ranges, settings)), settings)
    if texts.where(F.size("hot") > 0).limit(1).count():
        found = found.unionByName(_hot_ranges(texts, settings))
    ranges_of = found.groupBy("digest").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            out: list[list] = [[], []]
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                merged = merged_spans(((r["first"], r["last"]) for r in ranges), settings.length)
                out[0].append([{"start": a, "end": b} for a, b in merged])
                out[1].append(hashlib.sha256(without(text.encode(), merged)).hexdigest())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(out[0], kind), pa.array(out[1], pa.string())], names=["digest", "spans", "kept"])

    single = texts.where("copies = 1").select("digest", "text").join(ranges_of, "digest")
    some = single.mapInArrow(spans, "digest string, spans array<struct<start: long, end: long>>, kept string")
    by_text = once.select("digest", "copies").join(some, "digest", "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= settings.length)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start: long, end: long>>")
    joined = sizes.drop("grams").join(by_text, "digest")
    joined = joined.withColumn("spans", F.when(whole, everything).otherwise(F.coalesce("spans", none)))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return joined.select(
        F.when(F.col("doc_id") != no_id, F.col("doc_id")).alias("doc_id"), "digest", "n_bytes", "spans", removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )


def remove_repeated(docs: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with the spans cut out of the texts; null texts stay null. Bytes of a character that is cut apart go, too. Repeated
    rows repeat each other; an empty table stays empty; other columns pass by, whatever their names."""
    spans = repeated_spans(docs, settings, id_column, text_column).where("n_spans > 0").select("digest", "spans").dropDuplicates(["digest"])
    digest, cuts = fresh_name(docs.columns, "__digest"), fresh_name(docs.columns, "__spans")
    keyed = docs.withColumn(digest, F.md5(F.coalesce(F.col(text_column).cast("string"), F.lit(""))))
    joined = keyed.join(spans.toDF(digest, cuts), digest, "left").drop(digest)
    place = joined.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, place):
            texts = [
                t if t is None or not s else without(t.encode(), ((x["start"], x["end"]) for x in s)).decode("utf-8", "ignore")
                for t, s in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())
            ]
            columns = [*batch.columns[:-1]]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)
