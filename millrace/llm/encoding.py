"""Token ids of whole texts with a cache of words, exact for tokenizers that split texts before they merge.

A byte-pair tokenizer cuts a text into pieces and merges within each piece only. Wherever a cut before a single blank is
certain, encoding the parts one by one gives the same ids as encoding the text, and parts repeat: most of them come from
the cache. Texts with runs of white space are encoded whole by the library where blanks are part of pieces.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS = 500_000  # some 200 bytes each
JOINED_WORDS = 256
#: Marks that make one piece with one another; none that a contraction or a special token could hold.
_MARKS = b".,!?;:$%&*#"
_WHITE_RUN = re.compile(r"\s\s")


class CachedEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    `blank` says what the tokenizer does with white space: "dropped" (pieces hold none) or "leading" (a single blank
    belongs to the piece that follows it). Null is the empty text, which has no ids.
    """

    def __init__(self, path: str, blank: str, lower: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.blank, self.lower = blank, lower
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bounds = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.bounds[number] = token.endswith("</w>") if blank == "dropped" else token.startswith("Ġ")
        self.words: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _joined(self, words: list[bytes]) -> list[bytes]:
        """Many plain words in one call: each is one piece, whose first or last token shows."""
        between = " " if self.blank == "dropped" else ""
        groups = [words[i : i + JOINED_WORDS] for i in range(0, len(words), JOINED_WORDS)]
        out: list[bytes] = []
        texts = [between.join(w.decode() for w in g) for g in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            marks = np.flatnonzero(self.bounds[ids])
            if len(marks) != len(group):
                out += self._whole([w.decode() for w in group])
                continue
            data = ids.tobytes()
            cuts = 4 * (marks + 1 if self.blank == "dropped" else marks)
            cuts = [0, *cuts.tolist()] if self.blank == "dropped" else [*cuts.tolist(), len(data)]
            out += [data[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def _learn(self, words: Iterable[bytes]) -> None:
        """Encode new words without the marks at their end, which are a piece of their own after a letter. What a word is made
        of is kept as well, as a word."""
        ids, wanted, made = self.words, set(), []
        for word in words:
            core, tail = word, b""
            if word and word[-1] in _MARKS:
                core = word.rstrip(_MARKS)
                if core[-1:].isalpha() or core[-1:] > b"\x7f" and self._letter(core.decode()[-1]):
                    tail = word[len(core) :]
                else:
                    core = word
            if self.lower and core.isascii():
                core = core.lower()
            if tail or core != word:
                made.append((word, core, tail))
                wanted.add(tail)
            wanted.add(core)
        wanted.difference_update(ids.keys() & wanted)
        plain = [w for w in wanted if self._plain(w)]
        other = list(wanted.difference(plain))
        ids.update(zip(plain, self._joined(plain)))
        ids.update(zip(other, self._whole([w.decode() for w in other])))
        for word, core, tail in made:
            ids[word] = ids[core] + ids[tail]

    def _letter(self, character: str) -> bool:
        """Whether it ends as a letter: some capitals become a letter and a mark that is none."""
        return (character.lower() if self.lower else character)[-1].isalpha()

    def _plain(self, word: bytes) -> bool:
        letters = word if self.blank == "dropped" else word[1:] if word[:1] == b" " else b""
        return letters.isalpha() or not letters.isascii() and letters.decode().isalpha()

    def _parts(self, text: str) -> list[bytes] | None:
        data = text.encode()
        if self.blank == "dropped":
            return data.split()
        if b"\0" in data or _WHITE_RUN.search(text):
            return None
        return data.replace(b"\n", b"\0\n\0").replace(b" ", b"\0 ").split(b"\0")

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        parts = [self._parts(t or "") for t in texts]
        new = set(chain.from_iterable(filter(None, parts)))
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words = {}
        self._learn(new.difference(self.words) if self.words else new)
        get = self.words.__getitem__
        return [self._whole([t or ""])[0] if p is None else b"".join(map(get, p)) for t, p in zip(texts, parts)]


@lru_cache(maxsize=2)
def encoder(path: str, blank: str, lower: bool) -> CachedEncoder:
    """One encoder per Python worker, kept between tasks."""
    return CachedEncoder(path, blank, lower)


def by_size(batches: Iterable[pa.RecordBatch], column: str | int = "text", most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Batches cut into parts of about `most` bytes of a text or binary column, one row at least, before anything becomes a Python
    object: Spark limits batches to some 64 MB, and texts of such a batch with what is made of them would take several times that."""
    for batch in batches:
        if batch.num_rows < 2:
            yield batch
            continue
        sizes = np.array(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        part = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        yield from (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]))
    pa.default_memory_pool().release_unused()  # workers are used again by other stages


def groups_by_size(texts: list[str | None], most: int = 1 << 17) -> Iterable[slice]:
    """Slices of a batch of about `most` characters, one row at least, so that long texts come alone."""
    begin = size = 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield slice(begin, k + 1)
            begin, size = k + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))
