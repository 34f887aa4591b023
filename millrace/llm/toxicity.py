"""Toxic spans by a linear-chain conditional random field, document scores from its marginals.

Labels are given for documents. Words far more frequent in toxic documents (log-likelihood ratio G2) are tagged in toxic
documents; with these labelled tokens the field is trained on word, prefix and shape features. Scoring runs forward-backward
over every whole text and turns the marginals into a score by a logistic model, fitted on the same labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import crf
from millrace.llm.encoding import by_size, groups_by_size
from millrace.llm.spans import ALNUM, Words, hashes, per_document, prefixes, words_of

SAMPLE_ROWS = 2_400
SAMPLE_CHARS = 6_000
PREFIXES = (4, 6, 8)
SHAPES, SIZES = 4, 6
GROUP = 1 << 20


@dataclass
class Model:
    """`known[k]` are the sorted hashes of feature kind k, `weights[k]` theirs; unknown ones weigh nothing."""

    known: list[np.ndarray]
    weights: list[np.ndarray]
    shape: np.ndarray
    size: np.ndarray
    bias: float
    transition: np.ndarray
    calibration: np.ndarray

    def emissions(self, words: Words, codes: list[np.ndarray], shape: np.ndarray, size: np.ndarray) -> np.ndarray:
        total = self.bias + self.shape[shape] + self.size[size]
        for known, weights, code in zip(self.known, self.weights, codes):
            at = np.minimum(np.searchsorted(known, code), len(known) - 1)
            total = total + np.where(known[at] == code, weights[at], 0.0)
        return total


def token_features(words: Words, raw: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of the word and its prefixes, its shape (small, capital first, capitals, digit first) and size class."""
    size = words.end - words.start
    head, second = raw[words.start], raw[np.minimum(words.start + 1, len(raw) - 1)]
    capital = (head >= 65) & (head <= 90)
    shape = np.where((head >= 48) & (head <= 57), 3, np.where(capital & (size > 1) & (second >= 65) & (second <= 90), 2, np.where(capital, 1, 0)))
    return [hashes(words), *(prefixes(words, k) for k in PREFIXES)], shape, np.minimum(size // 3, SIZES - 1)


def _tokens(texts: list[str | None]) -> tuple[Words, list[np.ndarray], np.ndarray, np.ndarray]:
    raw = words_of(texts, ALNUM)
    words = words_of(texts, ALNUM, lower=True)
    return words, *token_features(words, raw.data)


def document_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """1, log of the expected number of toxic tokens, the largest marginal, the chance of any."""
    expected = per_document(p, first)
    quiet = per_document(np.log1p(-np.minimum(p, 1 - 1e-9)), first)
    highest = np.zeros(len(first) - 1)
    np.maximum.at(highest, np.repeat(np.arange(len(first) - 1), np.diff(first)), p)
    return np.stack([np.ones(len(expected)), np.log1p(expected), highest, -np.expm1(quiet)], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-6)) @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
    return w


def fit(texts: list[str], toxic: np.ndarray, share: float, min_documents: int = 3, evidence: float = 18.0, odds: float = 6.0) -> Model:
    """A model from labelled documents; `share` is the share of toxic documents where scores are used.

    With no toxic document every score is about `share`.
    """
    words, codes, shape, size = _tokens(texts)
    document = np.repeat(np.arange(len(texts)), np.diff(words.first))
    n1, n0 = max(int(toxic.sum()), 1), max(int((1 - toxic).sum()), 1)

    def frequencies(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes with the numbers of toxic and other documents."""
        known, index = np.unique(code, return_inverse=True)
        pairs = np.unique(index.astype(np.int64) * len(texts) + document)
        word, doc = pairs // max(len(texts), 1), pairs % max(len(texts), 1)
        return known, np.bincount(word, toxic[doc], len(known)), np.bincount(word, 1 - toxic[doc], len(known))

    known, a, b = frequencies(codes[0])
    expected = np.maximum((a + b) * n1 / (n1 + n0), 1e-9)
    rest = np.maximum((a + b) - expected, 1e-9)
    with np.errstate(divide="ignore", invalid="ignore"):
        g2 = 2 * (np.where(a > 0, a * np.log(a / expected), 0) + np.where(b > 0, b * np.log(b / rest), 0))
    marked = (a >= min_documents) & (g2 >= evidence) & (a / n1 >= odds * (b + 0.5) / n0)
    tags = (np.isin(codes[0], known[marked]) & (toxic[document] == 1)).astype(int)
    kept_hashes, columns, total = [], [], 0
    for k, code in enumerate(codes):
        values, a, b = (known, a, b) if k == 0 else frequencies(code)
        keep = values[(a + b >= min_documents) & (a > 0)]
        keep = keep if len(keep) else np.zeros(1, np.uint64)
        at = np.minimum(np.searchsorted(keep, code), len(keep) - 1)
        columns.append(total + np.where(keep[at] == code, at, len(keep)))
        kept_hashes.append(keep)
        total += len(keep) + 1
    columns += [total + shape, total + SHAPES + size, np.full(len(words), total + SHAPES + SIZES)]
    n_features = total + SHAPES + SIZES + 1
    weights, transition = np.zeros(n_features), np.array([[0.0, -2.0], [0.0, -2.0]])
    if len(words) and tags.any():
        weights, transition = crf.train(np.stack(columns), tags, words.first, n_features)
    split, begin = [], 0
    for keep in kept_hashes:
        split.append(weights[begin : begin + len(keep)])
        begin += len(keep) + 1
    fallback = [weights[sum(len(x) + 1 for x in kept_hashes[:k]) + len(keep)] for k, keep in enumerate(kept_hashes)]
    split = [w - f for w, f in zip(split, fallback)]
    shape_weights, size_weights = weights[total : total + SHAPES], weights[total + SHAPES : total + SHAPES + SIZES]
    model = Model(kept_hashes, split, shape_weights, size_weights, float(weights[-1] + sum(fallback)), transition, np.zeros(4))
    x = document_features(crf.marginals(model.emissions(words, codes, shape, size), words.first, transition), words.first)
    model.calibration = logistic(x, toxic) if len(texts) else np.zeros(4)
    model.calibration[0] += np.log(max(share, 1e-6) / max(1 - share, 1e-6)) - np.log(n1 / n0)
    return model


def score_texts(model: Model, texts: list[str | None], threshold: float) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores, and the spans whose tokens' marginals reach the threshold, as code point offsets with the mean marginal."""
    words, codes, shape, size = _tokens(texts)
    p = crf.marginals(model.emissions(words, codes, shape, size), words.first, model.transition)
    x = document_features(p, words.first)
    scores = 1 / (1 + np.exp(-np.clip(x @ model.calibration, -30, 30)))
    spans: list[list[dict]] = [[] for _ in texts]
    hit = np.flatnonzero(p >= threshold)
    owner = np.searchsorted(words.first, hit, "right") - 1
    for k, d in zip(hit.tolist(), owner.tolist()):
        begin = words.begin[d]
        encoded = words.data[begin : words.end[k]]
        leads = (encoded & 0xC0) != 0x80
        stop, start = int(leads.sum()), int(leads[: words.start[k] - begin].sum())
        last = spans[d][-1] if spans[d] else None
        if last and last["token"] == k - 1:
            last |= {"end": stop, "token": k, "sum": last["sum"] + p[k], "n": last["n"] + 1}
        else:
            spans[d].append({"start": start, "end": stop, "token": k, "sum": p[k], "n": 1})
    return scores, [[{"start": s["start"], "end": s["end"], "probability": float(s["sum"] / s["n"])} for s in x] for x in spans]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, chars: int, balanced: bool) -> DataFrame:
    """At most `rows` labelled documents of at most `chars` characters: text and label, ids chosen by hash, the same each
    time. With `balanced`, half of them at most have label 1, half label 0. Null labels and ids are left out."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    if balanced:
        halves = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows // 2) for y in (0, 1)]
        known = halves[0].unionByName(halves[1])
    else:
        known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= chars))
    # at most `rows` rows of two numbers
    found = texts.join(F.broadcast(known), "doc_id").select("doc_id", "text", "label")
    return found.dropDuplicates(["doc_id", "text"])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model:
    """Fit on a bounded sample of labelled documents (`rows` of at most `chars` characters each)."""
    sample = sorted(labelled_sample(docs, labels, label, rows, chars, True).collect(), key=lambda r: (r.doc_id, r.text))
    share = labels.where(F.col(label).isin(0, 1)).agg(F.avg(F.col(label).cast("double"))).first()[0]
    return fit([r.text for r in sample], np.array([r.label for r in sample], float), share if share is not None else 0.5)


def score(docs: DataFrame, model: Model, span_threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score and toxic spans (array of start, end, probability) of every document, texts whole.

    Null and empty texts have no tokens and the score of such. Repeated rows are scored one by one; null ids stay null; an
    empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            texts = batch.column("text").to_pylist()
            for group in groups_by_size(texts, GROUP):
                scores, spans = score_texts(model, texts[group], span_threshold)
                ids = batch.column("doc_id").slice(group.start, len(scores))
                yield pa.RecordBatch.from_arrays([ids, pa.array(scores), pa.array(spans, span)], names=["doc_id", "score", "spans"])

    return rows.mapInArrow(run, f"doc_id {kind}, score double, spans array<struct<start: long, end: long, probability: double>>")
