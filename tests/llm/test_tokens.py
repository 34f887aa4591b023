"""Token files and packing against the library's own encoding of whole texts."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import packing, tokens
from millrace.llm.encoding import CachedEncoder
from millrace.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER, tokenizer_path

KINDS = [("word_bpe_49k.json", WORD_TOKENIZER), ("byte_bpe_50k.json", BYTE_TOKENIZER)]


def library_ids(name, texts):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path(name)).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [x.ids + [1] for x in found]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name, kind", KINDS)
def test_cached_encoder_gives_the_librarys_ids(messy, name, kind):
    texts = [r[1] for r in messy] + ["É Ça,va. ΣΑΣ Σ.", "don't 's  x", "İ ǅ ﬁ", "\r\n x", "a \nb", "が か゛ é, ñ.,", "١٢ ² x².", " lead"]
    found = CachedEncoder(tokenizer_path(name), **kind)(texts)
    assert [np.frombuffer(x, "<u4").tolist() + [1] for x in found] == library_ids(name, texts)


@pytest.mark.parametrize("name, kind", KINDS)
def test_cached_encoder_on_words_with_marks(name, kind):
    rng = np.random.default_rng(11)
    cores = ["word", "Äh", "x", "é", "12", "a1", "don't", "I'll", "中", "ß", "<|endoftext|>", "(a", "", "ab-cd", "İ"]
    marks = ["", ".", ",", "!?", "$$$", "&&&", "...", "%;:", "#*", "'", "'s", ".'", "|>", "é.", "!!1"]
    blanks = [" ", "\n", " ", " ", "  "]
    texts = ["".join(rng.choice(cores) + rng.choice(marks) + rng.choice(blanks) for _ in range(12)) for _ in range(1500)]
    found = CachedEncoder(tokenizer_path(name), **kind)(texts)
    assert [np.frombuffer(x, "<u4").tolist() + [1] for x in found] == library_ids(name, texts)


@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_token_files_round_trip(docs, messy, tmp_path, kind):
    shards = tokens.write_tokens(docs, str(tmp_path), tokenizer_path("word_bpe_49k.json"), end_id=1, kind=kind, **WORD_TOKENIZER)
    found = tokens.read_tokens(shards, str(tmp_path), kind=kind).collect()
    encoded = library_ids("word_bpe_49k.json", [r[1] for r in messy])
    want = sorted((r[0] is not None, r[0] or 0, ids) for r, ids in zip(messy, encoded))
    got = sorted(((r.doc_id is not None, r.doc_id or 0, list(r.ids)) for r in found))
    assert got == want
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), crc(r.ids))
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(found, key=lambda r: r.start) if r.doc_id is not None]
    assert ids == sorted(ids)


def test_files_too_narrow_for_the_vocabulary_are_refused(docs, tmp_path):
    with pytest.raises(Exception, match="do not fit"):
        tokens.write_tokens(docs, str(tmp_path), tokenizer_path("word_bpe_49k.json"), end_id=1, kind="<u1", **WORD_TOKENIZER)


def test_empty_table(empty, tmp_path):
    shards = tokens.write_tokens(empty, str(tmp_path), tokenizer_path("word_bpe_49k.json"), end_id=1, **WORD_TOKENIZER)
    assert tokens.read_tokens(shards, str(tmp_path)).count() == 0
    assert packing.pack_tokens(empty, tokenizer_path("byte_bpe_50k.json"), end_id=1, **BYTE_TOKENIZER).count() == 0


def covered(parts):
    at = 0
    for start, size in sorted(parts):
        assert start == at and size > 0
        at += size
    return at


def test_packing_covers_every_id_once_without_padding(docs, messy):
    found = packing.pack_tokens(docs, tokenizer_path("byte_bpe_50k.json"), end_id=1, window=4, **BYTE_TOKENIZER).collect()
    encoded = library_ids("byte_bpe_50k.json", [r[1] for r in messy])
    by_id = {r[0]: ids for r, ids in zip(messy, encoded) if r[0] is not None}
    sequences, parts = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
        if r.doc_id not in (None, 2):  # row 2 comes twice
            assert r.ids_crc32 == crc(by_id[r.doc_id][r.start : r.start + r.length]) and r.doc_tokens == len(by_id[r.doc_id])
            parts[r.doc_id].append((r.start, r.length))
    assert {d: covered(p) for d, p in parts.items()} == {d: len(x) for d, x in by_id.items() if d != 2}
    assert sum(r.length for r in found) == sum(map(len, encoded))
    sizes = [covered(p) for p in sequences.values()]
    assert max(sizes) <= 2048 and all(s & (s - 1) == 0 for s in sizes)


def example(n, loss):
    flags = np.zeros(n, bool)
    flags[n - loss :] = True
    return packing.Example(n, np.zeros(n, np.uint32), flags, n)


def test_all_limits_hold_at_once():
    rng = np.random.default_rng(1)
    limits = packing.Limits(tokens=100, segments=3, loss=40)
    examples = [example(n, int(rng.integers(0, min(n, 40) + 1))) for n in rng.integers(1, 100, 200)]
    sequences, rest = packing.pack(examples, limits)
    assert not rest and sum(len(x.ids) for s in sequences for x in s) == sum(len(x.ids) for x in examples)
    for s in sequences:
        assert sum(len(x.ids) for x in s) <= 100 and len(s) <= 3 and sum(x.loss.sum() for x in s) <= 40


@pytest.mark.parametrize("limits", [packing.Limits(100, 1000, 100), packing.Limits(100, 3, 100), packing.Limits(100, 1000, 70)])
@pytest.mark.parametrize("more, cut", [(False, True), (True, True), (False, False)])
def test_packing_by_size_is_packing_by_product(limits, more, cut):
    """Without a loss mask the sorted list gives what the products of all waiting examples give."""
    rng = np.random.default_rng(7)
    sizes = rng.integers(1, 70, 300)

    def packed(mask):
        examples = [packing.Example(k, np.arange(n, dtype="<u4"), np.ones(n, bool) if mask else None, n) for k, n in enumerate(sizes)]
        sequences, rest = packing.pack(examples, limits, more, cut)
        return [[(x.doc, x.start, len(x.ids)) for x in s] for s in sequences], [(x.doc, x.start, len(x.ids)) for x in rest]

    assert packed(True) == packed(False)


def test_the_largest_product_comes_first():
    limits = packing.Limits(tokens=10, segments=10, loss=10)
    first = packing.pack([example(3, 0), example(4, 4), example(6, 0)], limits)[0][0]
    assert [len(x.ids) for x in first] == [4, 6]


def test_prompts_bear_no_loss(spark):
    rows = spark.createDataFrame([(1, "ask this: answer that", 9), (2, "no prompt", None)], "doc_id long, text string, prompt int")
    found = packing.pack_tokens(
        rows, tokenizer_path("byte_bpe_50k.json"), end_id=1, prompt_chars_column="prompt", keep_ids=True, **BYTE_TOKENIZER
    ).collect()
    lost = {d: sum(r.length - r.loss_tokens for r in found if r.doc_id == d) for d in (1, 2)}
    assert lost[1] == len(library_ids("byte_bpe_50k.json", ["ask this:"])[0]) - 1 and lost[2] == 0
