"""Best-fit packing against the library's own ids, a plain best fit, and the least possible number of sequences."""

import os
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.test_tokens import covered, crc

from millrace.llm import bestfit
from millrace.llm.queries import BYTE_TOKENIZER, QUERIES, table, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
TOKENIZER = tokenizer_path("byte_bpe_50k.json")


def ids_of(texts):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(TOKENIZER).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [x.ids + [0] for x in found]


def plain_best_fit(sizes, capacity):
    rooms, places = [], []
    for size in sizes:
        fitting = [k for k, room in enumerate(rooms) if room >= size]
        place = min(fitting, key=lambda k: rooms[k]) if fitting else len(rooms)
        if not fitting:
            rooms.append(capacity)
        rooms[place] -= size
        places.append(place)
    return sorted(capacity - r for r in rooms)


@given(st.lists(st.integers(1, 40), max_size=80))
@settings(max_examples=200, deadline=None)
def test_best_fit_is_that_of_a_plain_search(sizes):
    bins, offsets, fills = bestfit.best_fit(sizes, 40)
    held = defaultdict(list)
    for place, offset, size in zip(bins, offsets, sizes):
        held[place].append((offset, size))
    assert [covered(held[k]) for k in range(len(fills))] == fills
    assert sorted(fills) == plain_best_fit(sizes, 40)


@given(st.integers(1, 300))
@settings(deadline=None)
def test_only_the_first_piece_is_shorter(size):
    found = bestfit.cuts(size, 64)
    assert covered(found) == size and all(n == 64 for _, n in found[1:]) and len(found) == -(-size // 64)


def check(found, rows, capacity=2048):
    """Pieces cover every row once by the rule for cuts; sequences have no gap and hold `capacity` at most."""
    want = defaultdict(int)
    for (name, _), ids in zip(rows, ids_of([t for _, t in rows])):
        for k, (start, size) in enumerate(bestfit.cuts(len(ids), capacity)):
            want[name, k, start, size, crc(ids[start : start + size])] += 1
    got, sequences = defaultdict(int), defaultdict(list)
    for r in found:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    assert all(covered(s) <= capacity for s in sequences.values())
    return len(sequences), sum(r.length for r in found)


@pytest.mark.parametrize("window, group", [(1 << 16, 20_000), (3, 4), (1, 2)])
def test_pieces_and_sequences(docs, messy, window, group):
    found = bestfit.pack(docs, TOKENIZER, end_id=0, window=window, group=group, **BYTE_TOKENIZER).collect()
    check(found, [(r[0], r[1]) for r in messy])


def test_small_capacity(docs, messy):
    found = bestfit.pack(docs, TOKENIZER, end_id=0, capacity=64, window=5, **BYTE_TOKENIZER).collect()
    check(found, [(r[0], r[1]) for r in messy], 64)


def test_empty_table(empty):
    assert bestfit.pack(empty, TOKENIZER, end_id=0, **BYTE_TOKENIZER).count() == 0


def test_rounds_merge_across_many_tasks(spark):
    """2,000 bins of one task each, which only the tree can put together."""
    bins = spark.range(2_000).selectExpr("id AS bin", "CAST(CASE WHEN id % 2 = 0 THEN 60 ELSE 40 END AS int) AS fill").repartition(40)
    found = bestfit.merged_bins(bins, capacity=100, slack=0, group=50).collect()
    sizes = {k: 60 if k % 2 == 0 else 40 for k in range(2_000)}
    held = defaultdict(list)
    for r in found:
        held[r.sequence_id].append((r.shift, sizes[r.bin]))
    assert sorted(r.bin for r in found) == list(range(2_000)) and all(covered(x) <= 100 for x in held.values())
    assert len(held) <= 1_060  # 1,000 is the least; groups are dealt by hash


def test_bins_that_nothing_fits_end_the_rounds(spark):
    bins = spark.range(5_000).selectExpr("id AS bin", "51 AS fill")
    found = bestfit.merged_bins(bins, capacity=100, slack=0, group=100).collect()
    assert sorted((r.bin, r.sequence_id, r.shift) for r in found) == [(k, k, 0) for k in range(5_000)]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query_uses_few_sequences(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()]
    sequences, tokens = check(QUERIES["op13_best_fit_packing"](spark, FOLDER).collect(), docs)
    assert sequences <= 1.02 * tokens / 2048 + 1
