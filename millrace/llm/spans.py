"""Words of a batch of texts as arrays: where they start and end, whose they are, and 64-bit hashes, without a loop per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words without punctuation: ASCII letters and digits, and all bytes of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BLOCK = 1 << 20


def _mixed(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTES = _mixed(11, 256)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1024)
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _STEP)]))
    return _powers


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals as small letters; lengths stay."""
    out = _LOWER[data]
    after = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[after] += 0x20
    return out


@dataclass
class Words:
    """Bytes of all texts, each followed by a line feed; words as `start`, `end` into them; `first[d]` is document d's first
    word, `first[d + 1]` the first after it; `begin[d]` is where its text starts."""

    data: np.ndarray
    begin: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def words_of(texts: list[str | None], letters: np.ndarray, lower: bool = False) -> Words:
    """Words are maximal runs of bytes in `letters`; a null text has none."""
    parts = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"".join(p + b"\n" for p in parts), np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])]).astype(np.int64)
    inside = np.concatenate([[False], letters[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    return Words(lowered(data) if lower else data, begin, start, end, np.searchsorted(start, begin))


def hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.zeros(len(words), np.uint64)
    i = 0
    while i < len(words):
        j = max(i + 1, int(np.searchsorted(words.end, words.start[i] + BLOCK)))
        start, a, b = words.start[i:j], words.start[i], words.end[j - 1]
        size = (words.end[i:j] - start).astype(np.int64)
        head = np.cumsum(size) - size
        place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(head, size)
        inside = words.data[a:b][place + np.repeat(start - a, size)]
        values = _BYTES[inside] * powers(int(size.max()))[place]
        out[i:j] = np.add.reduceat(values, head)
        i = j
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def prefixes(words: Words, size: int) -> np.ndarray:
    """A hash of each word's first `size` bytes (8 at most); shorter words have that of the whole word."""
    code = np.zeros(len(words), np.uint64)
    last = len(words.data) - 1
    for k in range(size):
        at = words.start + k
        byte = np.where(at < words.end, words.data[np.minimum(at, last)], 0).astype(np.uint64)
        code |= byte << np.uint64(8 * k)
    code = (code + np.uint64(size)) * np.uint64(0x94D049BB133111EB)
    return code ^ (code >> np.uint64(31))


def per_document(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the words' values by document."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=float)])
    return total[first[1:]] - total[first[:-1]]
