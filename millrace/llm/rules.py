"""Quality rules: plain counts for every document, and a hashed n-gram log-likelihood ratio between a trusted target and
the raw corpus.

Words and pairs of neighbouring words are hashed into buckets. Bucket counts over all documents, and over all trusted ones,
give two multinomials; a document's ratio is the mean over its n-grams of log(target / raw). The number of buckets follows the
text up to a fixed bound, beyond which more n-grams share one and all ratios move towards 0. So documents are not rejected below
a given ratio, but below the one that all but a fixed share of held-out trusted documents reach, which moves alike.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.encoding import by_size, groups_by_size
from millrace.llm.spans import WHITE, Words, hashes, words_of
from millrace.session import cut

BUCKET_BITS = 14  # at least
MOST_BITS = 20  # 4 MB of weights in every worker, whatever the text
TEXT_PER_BUCKET = 192  # bytes; about 64 words and pairs, up to MOST_BITS
BLOCK_BITS = 12
WINDOW = 8
MIN_RATIO = -0.075
TRUSTED_SHARE = 0.01
STEPS = 4096
GROUP = 1 << 20
_SYMBOLS = list(b"#*$%&|<>")
_BLANKS = b" \t\n\v\f\r"
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0xA0761D6478BD642F)
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def bits_for(n_bytes: int) -> int:
    """Bits of a bucket's number for so much text."""
    return min(max(BUCKET_BITS, math.ceil(math.log2(max(n_bytes, 1) / TEXT_PER_BUCKET))), MOST_BITS)


def buckets_of(words: Words, codes: np.ndarray, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and of pairs within a document, and where each document's begin (one more than documents)."""
    shift = np.uint64(64 - bits)
    last = np.zeros(len(codes), bool)
    last[words.first[1:][np.diff(words.first) > 0] - 1] = True
    pairs = (codes[:-1] * _PAIR + codes[1:])[~last[:-1]] if len(codes) else codes
    out = np.concatenate([codes, pairs])
    owner = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    owner = np.concatenate([owner, owner[:-1][~last[:-1]] if len(codes) else owner])
    order = np.argsort(owner, kind="stable")
    found = ((out * _MIX) >> shift).astype(np.int64)[order]
    return found, np.searchsorted(owner[order], np.arange(len(words.first)))


def base_counts(text: str | None, codes: np.ndarray) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated windows; `codes` are hashes of the words."""
    data = (text or "").encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    points = int(counts[:128].sum() + counts[192:].sum())
    lines = [x for x in data.split(b"\n") if x.strip(_BLANKS)]
    repeated = 0
    if len(codes) >= WINDOW:
        rolling = np.zeros(len(codes) - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            rolling = rolling * _PAIR + codes[k : len(codes) - WINDOW + 1 + k]
        _, index, times = np.unique(rolling, return_inverse=True, return_counts=True)
        marks = np.zeros(len(codes) + 1, np.int64)
        twice = np.flatnonzero(times[index] > 1)
        np.add.at(marks, twice, 1)
        np.add.at(marks, twice + WINDOW, -1)
        repeated = int((np.cumsum(marks)[:-1] > 0).sum())
    return len(codes), points - int(counts[WHITE].sum()), int(counts[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated


def bucket_counts(docs: DataFrame, bits: int = BUCKET_BITS, text_column: str = "text") -> DataFrame:
    """block, counts (packed 64-bit numbers of 2**BLOCK_BITS buckets) over all documents. Each task adds up its own documents
    first and passes on blocks, not buckets; the sums over tasks are Spark's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in by_size(batches, 0):
            texts = batch.column(0).to_pylist()
            for group in groups_by_size(texts, GROUP):
                words = words_of(texts[group], WHITE_OUT)
                np.add.at(total, buckets_of(words, hashes(words), bits)[0], 1)
        blocks = total.reshape(-1, 1 << BLOCK_BITS)
        seen = np.flatnonzero(blocks.any(1))
        for k in range(0, len(seen), 256):
            part = seen[k : k + 256]
            packed = pa.array([zlib.compress(blocks[b].tobytes(), 1) for b in part], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), packed], names=["block", "counts"])

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(x), np.int64) for x in rows["counts"].to_pylist())
        return pa.table({"block": rows["block"][:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    kind = "block long, counts binary"
    return docs.select(text_column).mapInArrow(run, kind).groupBy("block").applyInArrow(add, kind)


WHITE_OUT = ~WHITE


@dataclass
class Ratio:
    """log(target / raw) by bucket."""

    weights: np.ndarray

    @property
    def bits(self) -> int:
        return len(self.weights).bit_length() - 1


def train(docs: DataFrame, trusted: DataFrame, smoothing: float = 1.0, bits: int | None = None) -> Ratio:
    """Count n-grams over all of `docs` and all of `trusted` (both with `text`). The driver gets one number for each bucket, and
    there is a bucket for every TEXT_PER_BUCKET bytes, 2**MOST_BITS at most, unless `bits` says otherwise. Target counts are
    smoothed towards the raw shares; without trusted documents all weights are 0."""
    if bits is None:
        bits = bits_for(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    raw, target = np.zeros(1 << bits, np.float32), np.zeros(1 << bits, np.float32)
    for into, rows in ((raw, docs), (target, trusted)):
        for block, counts in bucket_counts(rows, bits).toLocalIterator():
            into[block << BLOCK_BITS : block + 1 << BLOCK_BITS] = np.frombuffer(zlib.decompress(counts), np.int64)
    n_raw, n_target = raw.sum(dtype=float) + smoothing * len(raw), target.sum(dtype=float)
    pseudo = smoothing * len(raw)
    for first in range(0, len(raw), 1 << 20):  # in place and in pieces: the arrays grow with the text
        part = slice(first, first + (1 << 20))
        share = (raw[part].astype(float) + smoothing) / n_raw
        raw[part] = np.log((target[part] + pseudo * share) / (n_target + pseudo)) - np.log(share)
    return Ratio(raw)


def trusted_floor(scored: DataFrame, trusted: DataFrame, share: float = TRUSTED_SHARE) -> float:
    """The ratio that all but `share` of the trusted documents reach, of those that pass the base rules, rounded down to steps of
    1 / STEPS; `scored` is of `apply`, `trusted` has doc_id. It is on the scale of the ratios at hand, whatever the corpus;
    without such documents MIN_RATIO. Counts by step are exact, so the same documents always give the same ratio, and there are
    no more steps than logarithms of counts can span."""
    known = scored.where(~F.col("base_failed")).join(trusted.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = sorted(known.groupBy(F.floor(F.col("ratio") * STEPS).alias("step")).count().toLocalIterator())
    below, most = 0, share * sum(n for _, n in counts)
    for step, n in counts:
        below += n
        if below > most:
            return step / STEPS
    return MIN_RATIO


def judge(docs: DataFrame, trusted: DataFrame, share: float = TRUSTED_SHARE, bits: int | None = None) -> DataFrame:
    """`apply` with the ratio that all but `share` of trusted documents reach as the least; `trusted` has doc_id.

    A document's own n-grams raise its ratio, so the target is counted over three quarters of the trusted documents, by a
    hash of the id, and the least ratio comes from the others, which are as new to the model as the documents without a label.
    """
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 0
    target = docs.select("doc_id", "text").join(trusted.where(~held_out), "doc_id", "left_semi")
    scored = cut(apply(docs, train(docs, target, bits=bits)))
    least = trusted_floor(scored, trusted.where(held_out), share)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= least))


def apply(
    docs: DataFrame, ratio: Ratio, min_ratio: float = MIN_RATIO, min_words: int = 20, max_repeat_percent: int = 30,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Counts, `base_failed`, `ratio` (mean log-likelihood ratio; 0 without n-grams) and `kept` for every document.

    Null and empty texts have no words, so they fail the base rules. Repeated rows are judged one by one and alike, null ids
    stay null, an empty table gives no rows, other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = [x.split()[0] for x in BASE.split(", ")]
    bits, shipped = ratio.bits, docs.sparkSession.sparkContext.broadcast(ratio.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shipped.value
        for batch in by_size(batches):
            texts = batch.column("text").to_pylist()
            for group in groups_by_size(texts, GROUP):
                words = words_of(texts[group], WHITE_OUT)
                codes = hashes(words)
                buckets, first = buckets_of(words, codes, bits)
                total = np.concatenate([[0.0], np.cumsum(weights[buckets], dtype=float)])
                mean = (total[first[1:]] - total[first[:-1]]) / np.maximum(np.diff(first), 1)
                counts = np.array(
                    [base_counts(t, codes[a:b]) for t, a, b in zip(texts[group], words.first[:-1], words.first[1:])], np.int64
                )
                ids = batch.column("doc_id").slice(group.start, len(mean))
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, counts.T), pa.array(mean)], names=["doc_id", *names, "ratio"])

    found = rows.mapInArrow(run, f"doc_id {kind}, {BASE}, ratio double")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= min_ratio))
