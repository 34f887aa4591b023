"""A quality classifier: document statistics into gradient-boosted trees, trained on a bounded sample of labelled documents."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import trees
from millrace.llm.encoding import by_size
from millrace.llm.toxicity import labelled_sample

SAMPLE_ROWS = 20_000
SAMPLE_CHARS = 50_000
_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "white": [0x20, *range(0x09, 0x0E)],
    "stop": b".,;:?",
    "shout": b"!",
    "symbol": b"#*$%&|<>",
    "bracket": b"()[]{}\"'-_/=+@~^`\\",
    "lead": range(192, 256),
    "control": [*range(9), *range(14, 32), 127],
}
_TABLE = np.stack([np.isin(np.arange(256), list(codes)) for codes in _CLASSES.values()]).astype(float)
FEATURES = [
    "log_bytes", "log_words", "word_length", *_CLASSES, "distinct_words", "commonest_word", "repeated_next", "distinct_pairs",
    "lines", "repeated_lines", "line_words", "stops_per_word", "packed", "long_words", "bar_words", "letter_entropy",
]


def statistics(text: str | None) -> list[float]:
    """The features of one text, all finite; a null text is an empty one. No language, source or id is among them."""
    data = (text or "").encode()
    n = max(len(data), 1)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = _TABLE @ counts / n
    words = data.split()
    m = max(len(words), 1)
    frequency = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    k = max(len(lines), 1)
    following = list(zip(words, words[1:]))
    p = counts[counts > 0] / n
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        sum(map(len, words)) / m,
        *shares.tolist(),
        len(frequency) / m,
        (max(frequency.values()) if words else 0) / m,
        sum(a == b for a, b in following) / m,
        len(set(following)) / m,
        np.log1p(len(lines)),
        1 - len(set(lines)) / k,
        len(words) / k,
        float(counts[list(b".!?")].sum()) / m,
        len(zlib.compress(data, 1)) / n,
        sum(len(w) > 20 for w in words) / m,
        frequency[b"|"] / m,
        float(-(p * np.log(p)).sum()),
    ]


def matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts]).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> trees.Forest:
    """Fit on at most `rows` labelled documents of at most `chars` characters, chosen by a hash of the id. Statistics are
    computed by the executors; the driver gets `rows` short vectors."""
    sample = labelled_sample(docs, labels, label, rows, chars, False)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches):
            x = matrix(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "label", "x"]
            )

    kind = sample.schema["doc_id"].dataType.simpleString()
    found = sample.mapInArrow(measure, f"doc_id {kind}, label int, x array<double>").collect()
    found.sort(key=lambda r: (r.doc_id, r.x))
    return trees.train(np.array([r.x for r in found]).reshape(-1, len(FEATURES)), np.array([r.label for r in found], float))


def score(docs: DataFrame, forest: trees.Forest, id_column: str = "doc_id", text_column: str = "text", keep: str | bool = False) -> DataFrame:
    """doc_id and score of every document by its whole text; with `keep`, all columns of `docs` and the score in a column of
    that name (`__score` if it is True), which must be a new one.

    Null and empty texts have the statistics of an empty text. Repeated rows are scored one by one, null ids stay null, an
    empty table gives no rows, and other columns are passed by (`keep`) or not read.
    """
    keep = "__score" if keep is True else keep
    if keep and keep.lower() in [c.lower() for c in docs.columns]:
        raise ValueError(f"there is a column {keep}")
    rows = docs if keep else docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    text, name = (text_column, keep) if keep else ("text", "score")
    place = rows.columns.index(text)
    schema = rows.schema if keep else rows.select("doc_id").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, place):
            scores = forest.probabilities(matrix(batch.column(place).to_pylist()))
            columns = [*batch.columns] if keep else [batch.column(0)]
            names = [*batch.schema.names] if keep else ["doc_id"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], names=[*names, name])

    return rows.mapInArrow(run, T.StructType([*schema.fields, T.StructField(name, T.DoubleType())]))
