"""Ranked lexical search, term at a time with a limit on accumulators.

Documents stay where they are: each task builds inverted lists of the queries' terms for a block of its documents, and works
through every query's terms, rarest first. A document gets an accumulator only while it could still reach the kth best score:
once the upper bounds of the remaining terms add up to less than the kth partial score, no accumulator is created any more,
and those that exist are updated exactly. Tasks keep their k best for each query, which also bounds later blocks; a window over
these few rows gives the k best of all.

A first pass counts: documents, terms, and documents holding each term of the queries. It writes each document's counts of
query terms, so that texts are read once. Queries come in chunks of bounded size, each with passes of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.encoding import by_size, groups_by_size
from millrace.llm.spans import ALNUM, Words, hashes, words_of
from millrace.session import cut

TOP = 10
CHUNK_TERMS = 200_000  # terms of the queries that are searched, and shipped to the tasks, at a time
GROUP = 1 << 20
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32
INDEX = "doc_id long, n long, terms array<int>, times array<int>"
HITS = "item int, item_id long, doc_id long, score long"


def terms_of(texts: list[str | None]) -> Words:
    """ASCII letters and digits and all other characters above ASCII make terms; only A-Z are lower-cased."""
    words = words_of(texts, ALNUM)
    words.data = _ASCII_LOWER[words.data]
    return words


@dataclass
class Chunk:
    """Queries of one pass: their ids, and terms as numbers into `vocabulary` (sorted 64-bit hashes) with their repeats."""

    ids: list[int | None]
    terms: list[np.ndarray]
    times: list[np.ndarray]
    vocabulary: np.ndarray


def _chunk(rows: list[tuple[int | None, str | None]]) -> Chunk:
    words = terms_of([t for _, t in rows])
    codes = hashes(words)
    vocabulary, numbers = np.unique(codes, return_inverse=True)
    counted = [np.unique(numbers[a:b], return_counts=True) for a, b in zip(words.first[:-1], words.first[1:])]
    return Chunk([i for i, _ in rows], [t for t, _ in counted], [c for _, c in counted], vocabulary)


def chunks(rows: Iterable[tuple[int | None, str | None]], most: int) -> Iterator[Chunk]:
    """Queries in chunks of about `most` terms, one query at least."""
    held: list[tuple[int | None, str | None]] = []
    size = 0
    for name, text in rows:
        here = len(terms_of([text]))
        if held and size + here > most:
            yield _chunk(held)
            held, size = [], 0
        held.append((name, text))
        size += here
    if held:
        yield _chunk(held)


def index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Of each document: doc_id, number of terms, and which terms of the vocabulary it holds how often."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for batch in by_size(batches):
            texts = batch.column("text").to_pylist()
            for group in groups_by_size(texts, GROUP):
                words = terms_of(texts[group])
                codes, sizes = hashes(words), np.diff(words.first)
                place = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
                hit = known[place] == codes if len(known) else np.zeros(len(codes), bool)
                owner = np.repeat(np.arange(len(sizes)), sizes)[hit]
                pairs, times = np.unique(owner * max(len(known), 1) + place[hit], return_counts=True)
                owner, term = np.divmod(pairs, max(len(known), 1))
                cuts = pa.array(np.searchsorted(owner, np.arange(len(sizes) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (term, times)]
                ids = batch.column("doc_id").slice(group.start, len(sizes))
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "times"])

    return docs.mapInArrow(run, INDEX)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Postings:
    """Inverted lists of a block: documents and scores (before weights) of term t are at first[t] to first[t + 1]."""

    doc: np.ndarray
    part: np.ndarray
    first: np.ndarray
    most: np.ndarray
    n_docs: int


def postings(n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, times: np.ndarray, n_terms: int, n_docs: int, total: int) -> Postings:
    """`sizes` terms of each document lie end to end in `terms` and `times`; `n_docs` and `total` are those of the corpus."""
    long = 100 - 75 + (75 * n * n_docs) // max(total, 1)
    owner = np.repeat(np.arange(len(n)), sizes)
    times = times.astype(np.int64)
    part = (1_000_000_000 * times) // (1000 * times + 8 * long[owner])
    order = np.argsort(terms, kind="stable")
    first = np.searchsorted(terms[order], np.arange(n_terms + 1))
    most = np.zeros(n_terms, np.int64)
    held = np.flatnonzero(np.diff(first))
    if len(held):
        most[held] = np.maximum.reduceat(part[order], first[held])
    return Postings(owner[order], part[order], first, most, len(n))


def accumulate(lists: Postings, terms: np.ndarray, weights: np.ndarray, top: int, least: int = 0) -> tuple[np.ndarray, int]:
    """Scores by document of the block for terms in the given order, and after how many terms accumulators were no longer
    created. Documents whose score could not reach `least`, or the `top`th best here, may stay at 0; all others are exact."""
    scores = np.zeros(lists.n_docs, np.int64)
    bounds = weights * lists.most[terms]
    rest = np.concatenate([np.cumsum(bounds[::-1])[::-1][1:], [0]])
    alive: np.ndarray | None = None
    stopped = len(terms)
    for k, term in enumerate(terms):
        here = slice(lists.first[term], lists.first[term + 1])
        docs, added = lists.doc[here], weights[k] * lists.part[here]
        if alive is not None:
            scores[docs] += added * alive[docs]
            continue
        scores[docs] += added
        kth = least
        if rest[k] >= kth and lists.n_docs >= top and scores.max() > rest[k]:
            kth = max(kth, int(np.partition(scores, lists.n_docs - top)[lists.n_docs - top]))
        if rest[k] < kth:
            alive, stopped = scores > 0, k + 1
    return scores, stopped


def best(scores: np.ndarray, names: np.ndarray, nameless: np.ndarray, top: int) -> np.ndarray:
    """Places of the `top` highest scores above 0, equal ones by name, those without a name last."""
    found = np.flatnonzero(scores > 0)
    if len(found) > top:
        kth = np.partition(scores[found], len(found) - top)[len(found) - top]
        found = found[scores[found] >= kth]
    return found[np.lexsort((names[found], nameless[found], -scores[found]))][:top]


def _hits(indexed: DataFrame, chunk: Chunk, weights: np.ndarray, frequency: np.ndarray, n_docs: int, total: int, top: int) -> DataFrame:
    """The `top` best of each task for each query."""
    ordered = []
    for terms, times in zip(chunk.terms, chunk.times):
        order = np.lexsort((terms, frequency[terms]))
        order = order[weights[terms[order]] > 0]
        ordered.append((terms[order], weights[terms[order]] * times[order]))
    shipped = indexed.sparkSession.sparkContext.broadcast((chunk.ids, ordered))
    n_terms = len(chunk.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = shipped.value
        none = np.zeros(0, np.int64)
        held = [(none, none, none.astype(bool))] * len(ids)
        for batch in batches:
            names = batch.column("doc_id")
            nameless = np.array(names.is_null())
            names = np.array(names.fill_null(0))
            n = np.array(batch.column("n"))
            lists, times = batch.column("terms"), batch.column("times")
            sizes = np.diff(np.array(lists.offsets))
            block = postings(n, sizes, np.array(lists.flatten()), np.array(times.flatten()), n_terms, n_docs, total)
            for k, (terms, factors) in enumerate(queries):
                here = block.most[terms] > 0
                scores, docs, unnamed = held[k]
                least = int(scores[-1]) if len(scores) == top else 0
                found, _ = accumulate(block, terms[here], factors[here], top, least)
                places = best(np.where(found >= least, found, 0), names, nameless, top)
                if not len(places):
                    continue
                scores, docs = np.concatenate([scores, found[places]]), np.concatenate([docs, names[places]])
                unnamed = np.concatenate([unnamed, nameless[places]])
                order = best(scores, docs, unnamed, top)
                held[k] = scores[order], docs[order], unnamed[order]
        numbers = np.repeat(np.arange(len(ids)), [len(s) for s, _, _ in held])
        for first in range(0, len(numbers), 10_000):
            part = numbers[first : first + 10_000]
            scores, docs, unnamed = (np.concatenate([h[k] for h in held])[first : first + 10_000] for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array([ids[k] for k in part], pa.int64()), pa.array(docs, pa.int64(), mask=unnamed), pa.array(scores, pa.int64())],
                names=["item", "item_id", "doc_id", "score"],
            )

    return indexed.mapInArrow(run, HITS)


def search(
    docs: DataFrame,
    queries: DataFrame,
    top: int = TOP,
    chunk_terms: int = CHUNK_TERMS,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    query_column: str = "text",
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each query's `top` documents with a score above 0.

    A term's weight is floor(1000 * ln((2 N + 2) / (2 df + 1))) over N documents that have terms; a document adds for each
    of the query's terms, repeats included, weight * ((10**9 tf) div (1000 tf + 8 m)), m = 25 + (75 n N) div L, in 64-bit
    integers. Equal scores are ranked by ascending doc_id, documents without an id last. Null and empty texts have no terms:
    such queries have no rows, such documents count nowhere. Repeated document rows are documents of their own; queries that
    share id and text are one, those that share only the id are ranked apart. Empty tables give no rows; other columns are
    not read. Terms are told apart by 64-bit hashes.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    asked = queries.select(F.col(item_column).cast("long").alias("item_id"), F.col(query_column).cast("string").alias("text")).distinct()
    out = docs.sparkSession.createDataFrame([], f"rank int, {HITS}")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for chunk in chunks(((r.item_id, r.text) for r in asked.toLocalIterator()), chunk_terms):
        indexed = cut(index(rows, chunk.vocabulary))
        n_docs, total = indexed.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        counts = indexed.select(F.explode("terms").alias("term")).groupBy("term").count()
        frequency = np.zeros(len(chunk.vocabulary), np.int64)
        for r in counts.toLocalIterator():  # a number for each term of the chunk
            frequency[r["term"]] = r["count"]
        weights = np.array([weight(n_docs, df) for df in frequency.tolist()], np.int64)
        hits = _hits(indexed, chunk, weights, frequency, n_docs, total, top)
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        out = out.unionByName(cut(ranked))
    return out.select("item_id", "rank", "doc_id", "score")
