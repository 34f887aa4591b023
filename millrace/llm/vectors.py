"""Near-duplicate vectors: tiles of int8 codes are multiplied, and only pairs that may reach the threshold are recomputed.

A unit vector x is coded as s * q with integers q from -127 to 127; e = |x - s * q| is computed, not estimated. For two of
them |x . y - s_x s_y q_x . q_y| <= |s_x q_x| e_y + e_x, a bound for each pair from numbers of each vector, so no pair at or
above the threshold is missed; what passes is recomputed in double precision from the given vectors. Vectors are compared
within a label: its vectors are dealt into tiles by hash, and each pair of tiles is one group of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.graph import components
from millrace.session import cut

TILE = 2048
THRESHOLD = 0.98
_STRIP = 512


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, norms of the coded vectors and errors of rows, after scaling them to length 1."""
    unit = x / np.abs(x).max(1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.sqrt((coded * coded).sum(1)), np.sqrt(((unit - coded) ** 2).sum(1))


def near_one(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that squares neither overflow nor vanish; no bit of a cosine changes by it."""
    _, exponent = np.frexp(np.abs(x).max(1, keepdims=True))
    return np.ldexp(x, -exponent) if x.size else x


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of pairs of rows with a cosine of at least `threshold`; with `same`, each pair of different rows once."""
    a, b = near_one(a), near_one(b)
    qa, sa, na, ea = encode(a)
    qb, sb, _, eb = encode(b)
    # Products of codes are integers below 2**24 for up to 1,040 dimensions, which single precision adds exactly.
    kind = np.float32 if a.shape[1] <= 1040 else np.float64
    left, right = [], []
    for first in range(0, len(a), _STRIP):
        rows = slice(first, first + _STRIP)
        products = qa[rows].astype(kind) @ qb.astype(kind).T
        most = products * sa[rows, None] * sb[None] + na[rows, None] * eb[None] + ea[rows, None]
        i, j = np.nonzero(most >= threshold - 1e-6)
        i += first
        if same:
            i, j = i[i < j], j[i < j]
        for part in range(0, len(i), 1 << 16):
            k, m = i[part : part + (1 << 16)], j[part : part + (1 << 16)]
            x, y = a[k], b[m]
            cosine = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
            left.append(k[cosine >= threshold])
            right.append(m[cosine >= threshold])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int), np.zeros(0, int))


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n nodes over edges (i, j)."""
    root = np.arange(n)
    while True:
        new = root.copy()
        least = np.minimum(root[i], root[j])
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    tile: int = TILE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    Vectors link within equal labels and dimensions if their cosine reaches `threshold`. Those that are null, empty, zero or
    hold null or non-finite components, and those without a label or id, link with nothing: 0 links, their own component,
    kept. Equal vectors are compared once and counted as often as they occur. Rows that share an id are one node. An empty
    table gives no rows; other columns are not read.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).alias("label"),
        F.col(vector_column).cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable
    valid = rows.where(usable)
    copies = cut(valid.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    sizes = copies.groupBy("label", F.size("v").alias("n")).agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("tiles"))
    dealt = copies.withColumn("n", F.size("v")).join(sizes, ["label", "n"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("v", F.lit(8)), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("label", "n", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "copies", "v")

    def compare(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(parts)
        i, j = key[2].as_py(), key[3].as_py()
        x = np.array(group["v"].combine_chunks().flatten()).reshape(len(group), -1)
        own, rep, copies = (np.array(group[c]) for c in ("own", "rep", "copies"))
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        if len(a) and len(b):
            left, right = close_pairs(x[a], x[b], threshold, i == j)
            left, right = a[left], b[right]
            links = np.bincount(left, copies[right], len(rep)) + np.bincount(right, copies[left], len(rep))
            root = local_roots(len(rep), left, right)
            linked = np.flatnonzero(links)
            yield pa.RecordBatch.from_pydict(
                {"rep": pa.array(rep[linked]), "links": pa.array(links[linked].astype("i8")), "root": pa.array(rep[root[linked]])}
            )

    def by_table(key: tuple, group: pa.Table) -> pa.Table:
        found = list(compare(key, group.to_batches()))
        empty = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
        return pa.Table.from_batches(found, None if found else empty)

    found = cut(dealt.groupBy("label", "n", "i", "j").applyInArrow(by_table, "rep long, links long, root long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    reps = copies.join(links, "rep", "left").join(classes.withColumnRenamed("node", "rep"), "rep", "left")
    reps = reps.select("label", "v", F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.coalesce("component", "rep"))
    reps = reps.toDF("label", "v", "n_links", "component_id")
    linked = valid.join(reps, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return linked.unionByName(alone).withColumn("kept", kept)
