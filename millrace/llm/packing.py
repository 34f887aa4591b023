"""Packing examples into sequences under several limits at once, by a dot-product heuristic.

Every example has a demand vector (tokens, segments, loss-bearing tokens) against a capacity vector. A sequence takes,
again and again, the waiting example that fits and has the largest dot product of its demand with what is left, both as
shares of the capacity. Where nothing fits whole, the example with the largest product is cut to fill the sequence. A
sequence that cannot be filled ends in pieces whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.encoding import by_size, encoder, groups_by_size

WINDOW = 1024
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "loss_tokens long, segment long"
)


@dataclass(frozen=True)
class Limits:
    """Capacity of a sequence."""

    tokens: int = 2048
    segments: int = 1024
    loss: int = 2048


@dataclass
class Example:
    """A document's ids from `start` on; `loss` marks the ids that bear loss, None stands for all of them."""

    doc: int | None
    ids: np.ndarray
    loss: np.ndarray | None
    total: int
    start: int = 0

    def split(self, size: int) -> tuple[Example, Example]:
        first, rest = (None, None) if self.loss is None else (self.loss[:size], self.loss[size:])
        return Example(self.doc, self.ids[:size], first, self.total, self.start), Example(self.doc, self.ids[size:], rest, self.total, self.start + size)

    def bearing(self) -> int:
        return len(self.ids) if self.loss is None else int(self.loss.sum())


def fitting(example: Example, left: np.ndarray) -> int:
    """How many of its first ids fit into what is left."""
    size = int(min(len(example.ids), left[0])) if left[1] else 0
    if example.loss is None:
        return int(min(size, left[2]))
    if size and example.loss[:size].sum() > left[2]:
        size = int(np.searchsorted(np.cumsum(example.loss), left[2], "right"))
        size = int(min(size, left[0]))
    return size


def pack(examples: list[Example], limits: Limits, more: bool = False, cut: bool = True) -> tuple[list[list[Example]], list[Example]]:
    """Sequences of pieces, and what waits for later examples if `more` are to come.

    All examples must fit an empty sequence. With `more`, packing stops when the next sequence might not be filled. Without
    `cut`, examples stay whole.
    """
    if all(x.loss is None for x in examples):
        return _pack_by_size(list(examples), limits, more, cut)
    tokens = np.array([len(x.ids) for x in examples], float)
    loss = np.array([x.bearing() for x in examples], float)
    waiting = np.ones(len(examples), bool)
    total = tokens.sum()
    examples = list(examples)
    sequences = []
    while waiting.any():
        if more and total < 2 * limits.tokens:
            break
        left = [limits.tokens, limits.segments, limits.loss]
        taken: list[Example] = []
        while left[0] and left[1]:
            # one segment each: the same term for all examples, kept for the sake of the product
            score = tokens * (left[0] / limits.tokens**2) + loss * (left[2] / limits.loss**2) + left[1] / limits.segments**2
            fits = np.flatnonzero(waiting & (tokens <= left[0]) & (loss <= left[2]))
            if len(fits):
                k = int(fits[np.argmax(score[fits])])
                piece, waiting[k] = examples[k], False
            elif cut and waiting.any():
                k = int(np.argmax(np.where(waiting, score, -1)))
                size = fitting(examples[k], np.array(left))
                if not size:
                    break
                piece, examples[k] = examples[k].split(size)
                tokens[k], loss[k] = len(examples[k].ids), examples[k].bearing()
            else:
                break
            taken.append(piece)
            left = [left[0] - len(piece.ids), left[1] - 1, left[2] - piece.bearing()]
            total -= len(piece.ids)
        sequences.append(taken)
    return sequences, [examples[k] for k in np.flatnonzero(waiting)]


def _pack_by_size(examples: list[Example], limits: Limits, more: bool, cut: bool) -> tuple[list[list[Example]], list[Example]]:
    """`pack` where all ids bear loss: then the product grows with the size, so the largest that fits is found in a sorted list."""
    waiting = sorted((len(x.ids), -k) for k, x in enumerate(examples))
    total = sum(n for n, _ in waiting)
    most = min(limits.tokens, limits.loss)
    sequences = []
    while waiting and not (more and total < 2 * limits.tokens):
        left, taken = most, []
        while left and waiting and len(taken) < limits.segments:
            at = bisect_right(waiting, (left, 1)) - 1
            if at >= 0:
                size, k = waiting.pop(at)
                piece = examples[-k]
            elif cut:
                size, k = left, waiting.pop()[1]
                piece, examples[-k] = examples[-k].split(size)
                insort(waiting, (len(examples[-k].ids), k))
            else:
                break
            taken.append(piece)
            left, total = left - size, total - size
        sequences.append(taken)
    return sequences, [examples[k] for k in sorted(-k for _, k in waiting)]


def without_padding(sequence: list[Example], limits: Limits) -> Iterator[list[Example]]:
    """The sequence as it is if it is full, else cut into sequences whose lengths are powers of two."""
    size = sum(len(x.ids) for x in sequence)
    if size == limits.tokens:
        yield sequence
        return
    rest = list(sequence)
    while size:
        want = 1 << (size.bit_length() - 1)
        size -= want
        part = []
        while want:
            piece = rest.pop(0)
            if len(piece.ids) > want:
                piece, after = piece.split(want)
                rest.insert(0, after)
            part.append(piece)
            want -= len(piece.ids)
        yield part


def _whole_sequences(example: Example, limits: Limits) -> Iterator[tuple[Example, bool]]:
    """Cut what no sequence holds: full sequences' worth first, flagged, then the rest."""
    full = np.array([limits.tokens, limits.segments, limits.loss], float)
    while (size := fitting(example, full)) < len(example.ids):
        if not size:
            raise ValueError("a limit of no loss-bearing tokens cannot hold examples that bear loss")
        piece, example = example.split(size)
        yield piece, size == limits.tokens
    yield example, len(example.ids) == limits.tokens


def pack_tokens(
    docs: DataFrame,
    tokenizer: str,
    blank: str,
    lower: bool,
    end_id: int,
    limits: Limits = Limits(),
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    prompt_chars_column: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: its document, its place there, its sequence and its place in that, segment number included.

    Each task packs the documents it reads, `window` waiting examples at a time, with no shuffle; sequence ids are unique
    (task number times 2**33 plus a count). With `prompt_chars_column`, the ids of that many first characters bear no
    loss (prompt and rest are encoded apart). Null and empty texts are one end id. Null prompt lengths are 0. Repeated
    rows are packed one by one. An empty table gives no rows. Further columns are not read.
    """
    prompt = F.lit(0) if prompt_chars_column is None else F.coalesce(F.col(prompt_chars_column), F.lit(0))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), prompt.cast("long").alias("prompt")
    )
    with_prompt = prompt_chars_column is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer, blank, lower)
        sequence = TaskContext.get().partitionId() << 33
        waiting: list[Example] = []
        done: list[list[Example]] = []

        def out() -> pa.RecordBatch:
            nonlocal sequence
            names, rows, kept = [name.split()[0] for name in PIECES.split(", ")], [], []
            for pieces in done:
                offset = 0
                for segment, x in enumerate(pieces):
                    size = len(x.ids)
                    rows.append((x.doc, x.start, size, zlib.crc32(x.ids), x.total, sequence, offset, x.bearing(), segment))
                    if keep_ids:
                        kept.append(x.ids.astype("i8"))
                    offset += size
                sequence += 1
            done.clear()
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64()) for _ in names]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(columns, names=[*names, "ids"] if keep_ids else names)

        for batch in by_size(batches):
            numbers, texts, prompts = (batch.column(c).to_pylist() for c in ("doc_id", "text", "prompt"))
            for group in groups_by_size(texts):
                heads = [(t or "")[: max(p, 0)] for t, p in zip(texts[group], prompts[group])] if with_prompt else None
                rest = texts[group] if heads is None else [(t or "")[len(h) :] for t, h in zip(texts[group], heads)]
                first = encode_texts(heads) if heads else [b""] * len(rest)
                for number, a, b in zip(numbers[group], first, encode_texts(rest)):
                    ids = np.frombuffer(a + b + np.array([end_id], "<u4").tobytes(), "<u4")
                    loss = np.arange(len(ids)) >= len(a) // 4 if with_prompt else None
                    for piece, full in _whole_sequences(Example(number, ids, loss, len(ids)), limits):
                        (done.append([piece]) if full else waiting.append(piece))
                if len(waiting) >= window:
                    packed, waiting = pack(waiting, limits, more=True)
                    done += [x for s in packed for x in without_padding(s, limits)]
                if len(done) >= window:
                    yield out()
        done += [x for s in pack(waiting, limits)[0] for x in without_padding(s, limits)]
        yield out()

    schema = PIECES + (", ids array<long>" if keep_ids else "")
    return rows.mapInArrow(run, schema)
