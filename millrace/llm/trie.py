"""Prefix trie of conversations over range-partitioned paths, with a skeleton of splitter paths.

A conversation is a path: a digest for each turn, in order, without texts. Paths are cut into key ranges at sampled paths, the
splitters. The trie of the splitters is the skeleton, which every task gets: as ranges are contiguous, a node whose members lie in
more than one range is a prefix of the splitter below or above each of them, and so a skeleton node. Tasks walk through the
sorted paths of a range with a stack and finish all other nodes alone. Of a skeleton node each range gives a partial aggregate;
these are reduced by node, and sums over subtrees are differences of running sums in the skeleton's preorder.

Splitters are (path, id), so a path that very many conversations share is cut into several ranges as well.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.encoding import by_size
from millrace.session import cut

STEP = 32  # characters of a turn's digest
SAMPLES = 16  # sampled paths for each range
SAMPLE_CHARS = 1 << 26  # the driver's share of all sampled paths; longer paths are cut, which only moves splitters
CHUNK = 1 << 16  # characters of ids in a row
FLUSH = 8192  # rows
NO_ID = -(1 << 63)
EMPTY = hashlib.sha256().hexdigest()
PATHS = "conv_id long, steps array<struct<digest: string, size: int>>"
_NODE = (
    "kind int, sid long, parent_sid long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, size long, ends string, shard int, seq long"
)
_NAMES = [x.split()[0] for x in _NODE.split(", ")]
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
_SCHEMA = pa.schema([(x.split()[0], _KINDS[x.split()[1]]) for x in _NODE.split(", ")])
NODE, PARTIAL, ENDS = range(3)


def turn_paths(turns: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """One row per conversation: conv_id and steps, a digest of role and text and the text's code points for each turn.

    Turns are ordered by number, null first; turns that share a number by their digest. Null roles and texts are empty; rows
    without a conversation's id are left out; repeated rows are turns of their own; other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_column, text_column))
    number = F.col(turn_column).cast("long")
    step = F.struct(
        number.isNotNull().alias("numbered"),
        F.coalesce(number, F.lit(0)).alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.length(text).alias("size"),
    )
    rows = turns.select(F.col(id_column).cast("long").alias("conv_id"), step.alias("step")).where(F.col("conv_id").isNotNull())
    steps = F.transform(F.sort_array(F.collect_list("step")), lambda s: F.struct(s["digest"].alias("digest"), s["size"].alias("size")))
    return rows.groupBy("conv_id").agg(steps.alias("steps"))


def spliced(paths: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """Paths whose first h turns come from the family's first conversation, number c - c % family: all it has if fewer, none
    if it is absent; the conversation's own turns follow after its first h. h is crc32(c as text) % most. Remainders have the
    sign of c, as in SQL."""
    first = F.col("conv_id") % family == 0
    heads = paths.where(first).select(F.col("conv_id").alias("__base"), F.slice("steps", 1, max(most - 1, 1)).alias("__head"))
    keyed = paths.withColumn("__base", F.col("conv_id") - F.col("conv_id") % family)
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    head = F.coalesce(F.slice("__head", F.lit(1), h), F.slice("steps", F.lit(1), F.lit(0)))
    own = F.slice("steps", h + 1, F.size("steps"))
    return keyed.join(heads, "__base", "left").select("conv_id", F.concat(head, own).alias("steps"))


def common_steps(a: str, b: str) -> int:
    """Turns that two paths share from the start."""
    n = min(len(a), len(b)) // STEP
    if a[: n * STEP] == b[: n * STEP]:
        return n
    low, high = 0, n - 1
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * STEP] == b[: middle * STEP]:
            low = middle
        else:
            high = middle - 1
    return low


@dataclass
class Skeleton:
    """Splitters in order, and the trie of their paths: `ids[s][d]` is the node of splitter s at depth d. Nodes are numbered in
    preorder; `end` is the first number after a node's subtree."""

    splitters: list[tuple[str, int]]
    ids: list[list[int]] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    children: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        before = ""
        for path, _ in self.splitters:
            shared = common_steps(before, path)
            own = self.ids[-1][: shared + 1] if self.ids else []
            for depth in range(len(own), len(path) // STEP + 1):
                self.parent.append(own[-1] if own else -1)
                self.depth.append(depth)
                own.append(len(self.parent) - 1)
            self.ids.append(own)
            before = path
        self.end = list(range(1, len(self.parent) + 1))
        self.children = [0] * len(self.parent)
        for node in range(len(self.parent) - 1, 0, -1):
            up = self.parent[node]
            self.end[up] = max(self.end[up], self.end[node])
            self.children[up] += 1

    def rows(self) -> list[tuple]:
        return [(k, p if p >= 0 else None, d, e, c) for k, (p, d, e, c) in enumerate(zip(self.parent, self.depth, self.end, self.children))]


def skeleton_of(paths: DataFrame, ranges: int, sample_chars: int = SAMPLE_CHARS) -> Skeleton:
    """Splitters for about equal ranges of `paths` (conv_id, path). The driver gets some SAMPLES paths for each range, and of
    none more than its share of `sample_chars`; a splitter that is cut is a shorter path before all ids."""
    wanted = SAMPLES * ranges
    n = paths.count() if ranges > 1 else 0
    if not n:
        return Skeleton([])
    most = max(1, sample_chars // wanted // STEP) * STEP
    some = paths.where(F.pmod(F.xxhash64("conv_id", F.lit(7)), F.lit(max(1, math.ceil(n / wanted)))) == 0)
    taken = some.select(F.substring("path", 1, most).alias("path"), F.when(F.length("path") > most, NO_ID).otherwise(F.col("conv_id")).alias("id"))
    found = sorted((r["path"], r["id"]) for r in taken.toLocalIterator())
    return Skeleton(sorted({found[k * len(found) // ranges] for k in range(1, ranges)} if found else ()))


class _Open:
    """A node on the stack: `sid` is its number in the skeleton, or -1."""

    __slots__ = ("sid", "size", "conv", "n", "children", "leaves", "saved", "ends", "text", "seq", "waiting")

    def __init__(self, sid: int, size: int):
        self.sid, self.size = sid, size
        self.conv, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.text, self.seq, self.waiting = None, [], 0, []


class _Walk:
    """Walk through the sorted paths of one range; rows of finished nodes gather in `out`."""

    def __init__(self, shard: int, skeleton: Skeleton):
        self.shard, self.out = shard, {name: [] for name in _NAMES}
        between = [k for k in (shard - 1, shard) if 0 <= k < len(skeleton.splitters)]
        self.bounds = [(skeleton.splitters[k][0], skeleton.ids[k]) for k in between]
        self.before = ""
        self.stack = [_Open(0 if self.bounds else -1, 0)]

    def _row(self, **values) -> int:
        for name, column in self.out.items():
            column.append(values.get(name))
        return len(self.out["kind"]) - 1

    def add(self, path: str, conv: int, sizes: list[int]) -> pa.RecordBatch | None:
        """Paths come in order, equal ones by id. Gives a batch when many rows are there and none waits for its parent."""
        shared = common_steps(self.before, path)
        while len(self.stack) > shared + 1:
            self._close()
        full = len(self.out["kind"]) >= FLUSH and all(x.sid >= 0 for x in self.stack)
        batch = self.batch() if full else None
        near = [(common_steps(path, bound), ids) for bound, ids in self.bounds]
        for depth in range(shared + 1, len(path) // STEP + 1):
            sid = next((ids[depth] for known, ids in near if depth <= known), -1)
            self.stack.append(_Open(sid, sizes[depth - 1]))
        top = self.stack[-1]
        top.conv = conv if top.conv is None else min(top.conv, conv)
        top.n += 1
        if top.sid < 0:
            if top.ends is None:
                top.ends = hashlib.sha256(str(conv).encode())
            else:
                top.ends.update(f",{conv}".encode())
        else:
            top.text.append(str(conv))
            if len(top.text) >= CHUNK // 8:
                self._chunk(top)
        self.before = path
        return batch

    def _chunk(self, node: _Open) -> None:
        if node.text:
            self._row(kind=ENDS, sid=node.sid, shard=self.shard, seq=node.seq, ends=",".join(node.text))
            node.text, node.seq = [], node.seq + 1

    def _close(self) -> None:
        depth, node = len(self.stack) - 1, self.stack.pop()
        up = self.stack[-1] if self.stack else None
        if up is not None:
            up.conv = node.conv if up.conv is None else min(up.conv, node.conv)
            up.n += node.n
        if node.sid >= 0:
            self._chunk(node)
            self._row(
                kind=PARTIAL, sid=node.sid, conv_id=node.conv, n_convs=node.n, n_children=node.children, n_leaves=node.leaves,
                saved_tokens=node.saved, size=node.size,
            )
            return
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.n - 1) * node.size
        at = self._row(
            kind=NODE, conv_id=node.conv, depth=depth, n_convs=node.n, n_children=node.children, n_leaves=leaves, saved_tokens=saved,
            ends=node.ends.hexdigest() if node.ends else EMPTY, parent_sid=up.sid if up is not None and up.sid >= 0 else None,
        )
        for child in node.waiting:
            self.out["parent_conv_id"][child] = node.conv
        if up is None:
            return
        up.children, up.leaves, up.saved = up.children + 1, up.leaves + leaves, up.saved + saved
        if up.sid < 0:
            up.waiting.append(at)

    def end(self) -> None:
        while self.stack:
            self._close()

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(self.out[f.name], f.type) for f in _SCHEMA], schema=_SCHEMA)
        self.out = {name: [] for name in _NAMES}
        return out


def _walked(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Rows of all kinds: finished nodes, partial aggregates of skeleton nodes, and lists of ids that end there."""
    shipped = paths.sparkSession.sparkContext.broadcast(skeleton)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = shipped.value.splitters
        for batch in by_size(batches, "path"):
            rows = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            shards = pa.array([bisect_right(splitters, row) for row in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([shards, *batch.columns], names=["shard", *batch.schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk: _Walk | None = None
        for batch in by_size(batches, "path"):
            for shard, conv, path, sizes in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "sizes"))):
                if walk is None or walk.shard != shard:
                    if walk is not None:
                        walk.end()
                        yield walk.batch()
                    walk = _Walk(shard, shipped.value)
                full = walk.add(path, conv, sizes)
                if full is not None:
                    yield full
        if walk is not None:
            walk.end()
            yield walk.batch()

    dealt = paths.mapInArrow(deal, "shard int, conv_id long, path string, sizes array<int>")
    together = dealt.repartition(len(skeleton.splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    return together.mapInArrow(run, _NODE)


def _ends(chunks: DataFrame) -> DataFrame:
    """sid, ends_sha256: ids of each skeleton node in order, hashed as they stream by; a task keeps one hash state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        done: list[tuple[int, str]] = []
        for batch in batches:
            for sid, text in zip(batch.column("sid").to_pylist(), batch.column("ends").to_pylist()):
                if sid == at:
                    state.update(b",")
                else:
                    if state is not None:
                        done.append((at, state.hexdigest()))
                    at, state = sid, hashlib.sha256()
                state.update(text.encode())
        if state is not None:
            done.append((at, state.hexdigest()))
        columns = list(zip(*done)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())], names=["sid", "ends_sha256"])

    ordered = chunks.select("sid", "shard", "seq", "ends").repartition("sid").sortWithinPartitions("sid", "shard", "seq")
    return ordered.select("sid", "ends").mapInArrow(run, "sid long, ends_sha256 string")


def _reduced(walked: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Finished skeleton nodes. One task adds up the skeleton in preorder, which has as many rows as the splitters have turns."""
    partial = walked.where(F.col("kind") == PARTIAL).groupBy("sid").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("own_children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("size").alias("size"),
    )
    bones = walked.sparkSession.createDataFrame(skeleton.rows(), "sid long, parent long, depth long, end long, bones long")
    nodes = bones.join(partial, "sid").withColumn("n_children", F.col("own_children") + F.col("bones"))
    nodes = nodes.withColumns(
        {
            "leaves": F.col("leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0),
            "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("size"),
        }
    )
    before = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = cut(nodes.withColumns({"sum_leaves": F.sum("leaves").over(before), "sum_saved": F.sum("saved").over(before)}))
    last = sums.select((F.col("sid") + 1).alias("end"), F.col("sum_leaves").alias("to_leaves"), F.col("sum_saved").alias("to_saved"))
    names = sums.select(F.col("sid").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = sums.join(last, "end").join(names, "parent", "left")
    whole = whole.join(_ends(walked.where(F.col("kind") == ENDS)), "sid", "left")
    return whole.select(
        "sid", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("to_leaves") - F.col("sum_leaves") + F.col("leaves")).alias("n_leaves"),
        (F.col("to_saved") - F.col("sum_saved") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def prefix_trie(paths: DataFrame, ranges: int | None = None, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """One row per node of the trie of `paths` (conv_id, steps): conv_id (its smallest member), depth, parent_conv_id, n_convs
    (members), n_children, n_leaves, saved_tokens (summed over its subtree: sizes that members but one need not repeat) and
    ends_sha256 (of the ids of members that end there, ascending, joined by commas).

    Conversations without turns end at the root. Rows without an id are left out; an id must not come twice; without
    conversations there is no node; other columns are not read. There are `ranges` key ranges (by default as many as shuffle
    partitions); the result is the same for any number. A conversation is one row of some 40 bytes a turn, and a task holds
    the open path and the finished nodes below its highest node that is not in the skeleton.
    """
    ranges = ranges or int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    path = F.array_join(F.transform("steps", lambda s: s["digest"]), "")
    sizes = F.transform("steps", lambda s: s["size"])
    named = paths.where(F.col("conv_id").isNotNull())
    rows = cut(named.select(F.col("conv_id").cast("long").alias("conv_id"), path.alias("path"), sizes.alias("sizes")))
    skeleton = skeleton_of(rows, ranges, sample_chars)
    walked = cut(_walked(rows, skeleton))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = walked.where(F.col("kind") == NODE).withColumn("ends_sha256", F.col("ends"))
    if not skeleton.splitters:
        return found.select(*columns)
    bones = cut(_reduced(walked, skeleton))
    hanging = found.where(F.col("parent_sid").isNotNull()).drop("parent_conv_id")
    hanging = hanging.join(bones.select(F.col("sid").alias("parent_sid"), F.col("conv_id").alias("parent_conv_id")), "parent_sid")
    inner = found.where(F.col("parent_sid").isNull())
    return inner.select(*columns).unionByName(hanging.select(*columns)).unionByName(bones.select(*columns))
