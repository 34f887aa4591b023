"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian verification of signatures, exact confirmation.

Texts with the same words are one node, whatever their ids. Signatures of nodes are cut into bands; nodes with an equal band share a
bucket. Candidates of a bucket are first its star (each member with the one that meets most nodes in its buckets), so a
bucket of m members gives m - 1 pairs, not m squared. Signatures of a pair are compared a batch at a time, and a pair is
dropped as soon as the posterior probability of a similarity at or above the threshold falls below the miss probability.
Survivors are confirmed on full shingle sets. Confirmed links join nodes. What is not joined yet is then compared in blocks of
bounded size: in each bucket all that lies outside its largest component, with everything but its own component. A block's
survivors are confirmed inside its task, which passes on the few links that join its components, not the pairs. So a component
loses no link but by the miss probability of bands and pruning.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.encoding import by_size, groups_by_size
from millrace.llm.graph import components
from millrace.llm.spans import WHITE, Words, hashes, words_of
from millrace.session import cut

_LETTERS = ~WHITE
_STEP = np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0xA0761D6478BD642F)
GROUP = 1 << 20
LARGE = 16  # blocks of a bucket whose members first meet their own block only


@dataclass(frozen=True)
class Settings:
    """`size` words a shingle, links at `percent` of the union and more; `bands` of `rows` minima make candidates, `hashes`
    minima in all are compared `batch` at a time; a pair goes when its posterior chance to be a link is below `miss`. What all
    steps together lose is told by `pruning_loss`. Blocks have about `block` nodes and `mass` shingles a side."""

    size: int = 4
    percent: int = 80
    bands: int = 24
    rows: int = 4
    hashes: int = 256
    batch: int = 32
    miss: float = 1e-6
    block: int = 512
    mass: int = 1 << 20  # shingles of a block


@lru_cache(maxsize=4)
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(5)
    return random.integers(0, 1 << 32, n, dtype=np.uint32), random.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _folded(texts: list[str | None]) -> Words:
    """Words with A-Z lower-cased, other characters as they are."""
    words = words_of(texts, _LETTERS)
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    words.data = table[words.data]
    return words


def shingles(codes: np.ndarray, size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of a document's word hashes; a shorter one is a single shingle."""
    if not len(codes):
        return codes
    width = min(size, len(codes))
    out = np.full(len(codes) - width + 1, width, np.uint64)
    for k in range(width):
        out = (out + codes[k : k + len(out)]) * _STEP
        out ^= out >> np.uint64(29)
    return np.unique(out * _MIX)


def signature(found: np.ndarray, n: int) -> np.ndarray:
    """Minima of the set under n permutations of 32-bit numbers."""
    mask, factor = _permutations(n)
    low = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(n, np.uint32(0xFFFFFFFF))
    for first in range(0, len(low), 512):
        values = low[first : first + 512, None] ^ mask
        values *= factor
        out = np.minimum(out, values.min(0))
    return out


def _low_bytes(minima: np.ndarray) -> bytes:
    """A mixed byte of each minimum: unequal minima agree in one of 256, so similarity is never underrated."""
    return ((minima * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def least_matches(n: int, threshold: float, miss: float) -> int:
    """The fewest equal minima of n at which the posterior P(similarity >= threshold) is `miss` or more, for a uniform prior."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    for m in range(n + 1):
        logs = m * np.log(grid) + (n - m) * np.log1p(-grid)
        weight = np.exp(logs - logs.max())
        if weight[grid >= threshold].sum() >= miss * weight.sum():
            return m
    return n


def surviving(a: np.ndarray, b: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Sequential test of pairs of signatures (rows of a and b): which survive, and the share of equal minima seen."""
    live, matches = np.arange(len(a)), np.zeros(len(a), int)
    for done in range(0, settings.hashes, settings.batch):
        columns = slice(done, done + settings.batch)
        matches[live] += (a[live, columns] == b[live, columns]).sum(1)
        seen = min(done + settings.batch, settings.hashes)
        live = live[matches[live] >= least_matches_of(seen, settings)]
    return live, matches[live] / settings.hashes


@lru_cache(maxsize=64)
def least_matches_of(seen: int, settings: Settings) -> int:
    return least_matches(seen, settings.percent / 100, settings.miss)


def copy_of(text_column: str) -> Column:
    """Names a text byte by byte; null and empty texts differ."""
    return F.coalesce(F.unhex(F.md5(F.col(text_column).cast("string"))), F.lit(b""))


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, copy (of the text), print (of the words in order; null without words), n_shingles, signature and band keys of each row."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, copy binary, print binary, n_shingles long, signature binary, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            texts = batch.column("text").to_pylist()
            for group in groups_by_size(texts, GROUP):
                words = _folded(texts[group])
                codes = hashes(words)
                rows: list[list] = [[], [], [], []]
                for a, b in zip(words.first[:-1], words.first[1:]):
                    found = shingles(codes[a:b], settings.size)
                    if not len(found):
                        for out, value in zip(rows, (None, 0, None, None)):
                            out.append(value)
                        continue
                    minima = signature(found, settings.hashes)
                    keys = minima[: settings.bands * settings.rows].reshape(settings.bands, -1).astype(np.uint64)
                    key = np.arange(1, settings.bands + 1, dtype=np.uint64) * _MIX
                    for k in range(settings.rows):
                        key = (key ^ keys[:, k]) * _STEP
                        key ^= key >> np.uint64(31)
                    text = b" ".join(words.data[s:e].tobytes() for s, e in zip(words.start[a:b], words.end[a:b]))
                    for out, value in zip(rows, (hashlib.md5(text).digest(), len(found), _low_bytes(minima), key.view(np.int64))):
                        out.append(value)
                ids, copies = (batch.column(c).slice(group.start, len(rows[0])) for c in ("doc_id", "copy"))
                kinds = (pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, copies, *(pa.array(x, k) for x, k in zip(rows, kinds))], names=["doc_id", "copy", "print", "n_shingles", "signature", "bands"]
                )

    return docs.mapInArrow(run, schema)


def _pruned(pairs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """a, b, seen: pairs that survive the sequential test."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, settings.hashes) for c in ("sa", "sb")]
            live, seen = surviving(*sides, settings)
            at = pa.array(live)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at), pa.array(seen)], names=["a", "b", "seen"])

    signed = nodes.select("node", "signature", "n_shingles")
    left = signed.toDF("a", "sa", "na")
    right = signed.toDF("b", "sb", "nb")
    # sets of such different sizes cannot be as similar
    sized = 100 * F.least("na", "nb") >= settings.percent * F.greatest("na", "nb")
    both = pairs.join(left, "a").join(right, "b").where(sized)
    return both.select("a", "b", "sa", "sb").mapInArrow(test, "a long, b long, seen double")


def _sets(texts: DataFrame, settings: Settings) -> DataFrame:
    """node and its shingles as sorted 64-bit numbers, from node and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            found = [shingles(hashes(_folded([t])), settings.size).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], names=["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles binary")


def _linked(a: np.ndarray, b: np.ndarray, settings: Settings) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= settings.percent * (len(a) + len(b) - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """a, b and whether 100 * intersection >= percent * union on full sets."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("sa"), batch.column("sb"))
            out = [_linked(np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64), settings) for p, q in sides]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.bool_())], names=["a", "b", "linked"])

    both = pairs.select("a", "b").join(sets.toDF("b", "sb"), "b").join(sets.toDF("a", "sa"), "a")
    return both.select("a", "b", "sa", "sb").mapInArrow(confirm, "a long, b long, linked boolean")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """node, component for all nodes."""
    classes = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return nodes.select("node").join(classes, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def near_duplicates(
    docs: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id of the component) and kept for every row.

    Null and empty texts and those without words have no shingles, link with nothing and are kept. Rows without an id, too,
    and have no component. Rows that share an id but not their words are texts of their own: each is linked and judged by
    itself, and one of a component is kept. Repeated rows and equal texts are joined without a comparison. An empty table gives
    no rows; other columns are not read.
    """
    return judged(docs, settings, id_column, text_column).select("doc_id", "n_shingles", "component_id", "kept")


def judged(
    docs: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """`near_duplicates` with the `copy` and the `print` (null without words) of each row's text."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.withColumn("copy", copy_of("text"))
    sketched = cut(sketches(rows, settings))
    usable = F.col("doc_id").isNotNull() & F.col("print").isNotNull()
    prints = sketched.where(usable).groupBy("print").agg(F.min(F.struct("doc_id", "copy")).alias("first"))
    prints = cut(prints.select("print", "first.*", F.monotonically_increasing_id().alias("node")))
    members = sketched.select("doc_id", "copy", "print", "n_shingles")
    signed = sketched.where(usable).join(prints, ["print", "doc_id", "copy"])
    nodes = cut(signed.dropDuplicates(["node"]).select("node", "n_shingles", "signature", "bands"))

    banded = nodes.select("node", F.explode("bands").alias("band"))
    sizes = cut(banded.groupBy("band").agg(F.count("*").alias("m")).where("m > 1"))  # apart, so that hot buckets can be split
    shared = cut(banded.join(sizes, "band"))  # only buckets with more than one member
    # whole texts move once, and only those that meet others; from then on their shingles stand for them
    places = prints.join(shared.select("node").distinct(), "node", "left_semi").select("doc_id", "copy", "node")
    sets = cut(_sets(rows.join(places, ["doc_id", "copy"]).dropDuplicates(["doc_id", "copy"]).select("node", "text"), settings))
    met = shared.groupBy("node").agg(F.sum("m").alias("met"))
    centres = shared.join(met, "node").groupBy("band").agg(F.max(F.struct("met", F.xxhash64("node").alias("h"), "node")).alias("s"))
    stars = cut(centres.select("band", F.col("s.node").alias("star")))
    pairs = shared.join(stars, "band").where("node <> star").select(*_ordered("node", "star")).distinct()
    found = cut(_pruned(pairs, nodes, settings))
    # each node's best candidate: one link joins it, and most others need no confirmation
    ends = found.select("a", "b", "seen", F.explode(F.array("a", "b")).alias("end"))
    best = ends.groupBy("end").agg(F.max(F.struct("seen", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
    tested = cut(_confirmed(best, sets, settings))
    labels = cut(_labelled(nodes, tested.where("linked")))

    # then what is still apart; members of large buckets first meet those of their own block, which joins most of them
    links = tested.where("linked").select("a", "b")
    large = sizes.where(F.col("m") > LARGE * settings.block)
    if not large.isEmpty():
        links = links.unionByName(_across(shared.join(large.select("band"), "band", "left_semi"), nodes, labels, sets, settings, own=True))
        labels = cut(_labelled(nodes, links))
    links = links.unionByName(_across(shared, nodes, labels, sets, settings))
    labels = _labelled(nodes, links)

    named = cut(prints.join(labels, "node").select("print", "doc_id", "component"))
    # a component is named by its smallest id; of texts that share this id one is kept
    heads = named.groupBy("component").agg(F.min(F.struct("doc_id", "print")).alias("head"))
    named = named.join(heads, "component").select("print", "head")
    mine = (F.col("doc_id") == F.col("head.doc_id")) & (F.col("print") == F.col("head.print"))
    known = members.where(usable).join(named, "print")
    known = known.select("doc_id", "copy", "print", "n_shingles", F.col("head.doc_id").alias("component_id"), mine.alias("kept"))
    alone = members.where(~usable).select("doc_id", "copy", "print", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return known.unionByName(alone)


_BLOCK = "band long, i int, j int, side int, node long, component long, n_shingles long, signature binary, bands array<long>"
_KEY = ("band", "i", "j")


def _dealt(shared: DataFrame, nodes: DataFrame, labels: DataFrame, settings: Settings, own: bool) -> DataFrame:
    """Rows of _BLOCK: members of buckets with several components, dealt into blocks. Those outside a bucket's largest component
    (`rest`) meet every block of the largest, and every block of the rest; with `own`, all members only their own block.
    `side` says whom a row is compared with: 0 with 1, and 2 with one another."""
    inside = cut(shared.select("band", "node").join(labels, "node").join(nodes.select("node", "n_shingles"), "node"))
    per = inside.groupBy("band", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("mass"))
    top = F.max(F.struct("n", "component", "mass"))
    bucket = per.groupBy("band").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum("mass").alias("mass"), top.alias("top"))

    def blocks(n: Column, mass: Column) -> Column:
        return F.greatest(F.ceil(n / F.lit(settings.block)), F.ceil(mass / F.lit(settings.mass)), F.lit(1)).cast("int")

    mixed = cut(
        bucket.where("parts > 1").select(
            "band", F.col("top.component").alias("largest"), blocks(F.col("n"), F.col("mass")).alias("all_blocks"),
            blocks(F.col("top.n"), F.col("top.mass")).alias("large_blocks"),
            blocks(F.col("n") - F.col("top.n"), F.col("mass") - F.col("top.mass")).alias("rest_blocks"),
        )
    )
    dealt = inside.drop("n_shingles").join(mixed, "band").join(nodes.select("node", "n_shingles", "signature", "bands"), "node")
    code = F.xxhash64("node")

    def place(i: Column, j: Column, side: Column) -> Column:
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

    def upto(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    if own:
        here = F.pmod(code, F.col("all_blocks"))
        places = F.array(place(here, here, F.lit(2)))
    else:
        large = F.pmod(code, F.col("large_blocks"))
        rest = F.pmod(code, F.col("rest_blocks"))
        first = F.col("large_blocks")
        of_large = F.transform(upto("rest_blocks"), lambda j: place(large, j, F.lit(0)))
        with_large = F.transform(upto("large_blocks"), lambda i: place(i, rest, F.lit(1)))
        among = F.transform(
            upto("rest_blocks"),
            lambda j: place(first + F.least(rest, j), F.greatest(rest, j), F.when(rest == j, 2).when(rest < j, 0).otherwise(1)),
        )
        places = F.when(F.col("component") == F.col("largest"), of_large).otherwise(F.concat(with_large, among))
    spread = dealt.withColumn("place", F.explode(places))
    return spread.select("band", "place.i", "place.j", "place.side", "node", "component", "n_shingles", "signature", "bands")


def _survivors(rows: pa.Table, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of pairs of a block that lie in different components and survive the sequential test, and their equal minima. Each
    pair is found in the first bucket that both share."""
    side, component, size = (np.array(rows[c]) for c in ("side", "component", "n_shingles"))
    signed = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint8).reshape(-1, settings.hashes)
    bands = np.array(rows["bands"].combine_chunks().flatten()).reshape(-1, settings.bands)
    band = rows["band"][0].as_py()
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    found: list[list[np.ndarray]] = [[], [], []]
    for first in range(0, len(left), 64):
        here = left[first : first + 64]
        near_size = 100 * np.minimum(size[here, None], size[right]) >= settings.percent * np.maximum(size[here, None], size[right])
        once = (side[here, None] != 2) | (here[:, None] < right)
        x, y = np.nonzero(near_size & (component[here, None] != component[right]) & once)
        x, y = here[x], right[y]
        live, seen = surviving(signed[x], signed[y], settings)
        x, y = x[live], y[live]
        reported = bands[x, (bands[x] == bands[y]).argmax(1)] == band
        for out, values in zip(found, (x[reported], y[reported], seen[reported])):
            out.append(values)
    x, y, seen = (np.concatenate(f) if f else np.zeros(0, int) for f in found)
    return x, y, seen


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Blocks of rows that come sorted by _KEY; the last block of a batch may go on in the next."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.stack([np.array(batch.column(c)).astype(np.int64) for c in _KEY], 1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
        for first, last in zip(cuts, cuts[1:]):
            part = batch.slice(first, last - first)
            if waiting and any(waiting[0].column(c)[0] != part.column(c)[0] for c in _KEY):
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(part)
    if waiting:
        yield pa.Table.from_batches(waiting)


def _joining(rows: pa.Table, settings: Settings) -> tuple[list[int], list[int]]:
    """Places of pairs of a block that are links and join its components, one less than the nodes at most."""
    x, y, seen = _survivors(rows, settings)
    parts = rows["component"].to_pylist()
    root = {p: p for p in parts}

    def find(p: int) -> int:
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    held = rows["shingles"]
    opened: dict[int, np.ndarray] = {}
    a, b = [], []
    order = np.argsort(-seen, kind="stable")
    for p, q in zip(x[order].tolist(), y[order].tolist()):
        one, other = find(parts[p]), find(parts[q])
        if one == other:
            continue
        for k in (p, q):
            if k not in opened:
                opened[k] = np.frombuffer(held[k].as_buffer(), np.uint64)
        if _linked(opened[p], opened[q], settings):
            root[one] = other
            a.append(p)
            b.append(q)
    return a, b


def _across(
    shared: DataFrame, nodes: DataFrame, labels: DataFrame, sets: DataFrame, settings: Settings, own: bool = False
) -> DataFrame:
    """a, b: links that join components within blocks. Signatures of a block are compared first; the rows that have a survivor
    get their shingles, are compared once more, and confirmed, in one task. Rows out are nodes, never pairs."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_block(batches):
            x, y, _ = _survivors(rows, settings)
            if len(x):
                yield from rows.take(pa.array(np.union1d(x, y))).to_batches()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_block(batches):
            a, b = (rows["node"].take(pa.array(p, pa.int64())).combine_chunks() for p in _joining(rows, settings))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    dealt = _dealt(shared, nodes, labels, settings, own).repartition(*_KEY).sortWithinPartitions(*_KEY)
    marked = cut(dealt.mapInArrow(mark, _BLOCK))
    ready = marked.join(sets, "node").repartition(*_KEY).sortWithinPartitions(*_KEY, "node")
    return cut(ready.mapInArrow(join, "a long, b long"))


def pruning_loss(similarity: float, settings: Settings) -> float:
    """The chance that the sequential test drops a pair of this similarity at any of its steps. Minima are kept as bytes, so
    unequal ones agree in one of 256."""
    p = similarity + (1 - similarity) / 256
    alive = np.ones(1)
    step = np.array([math.comb(settings.batch, k) * p**k * (1 - p) ** (settings.batch - k) for k in range(settings.batch + 1)])
    for seen in range(settings.batch, settings.hashes + 1, settings.batch):
        alive = np.convolve(alive, step)
        alive[: least_matches_of(seen, settings)] = 0
    return float(1 - alive.sum())


def bands_miss(similarity: float, settings: Settings) -> float:
    """The chance that a pair of this similarity shares no bucket."""
    return math.pow(1 - similarity**settings.rows, settings.bands)
