"""Ranked search against a plain scorer of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import prose

from millrace.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, top=10):
    """Sorted (item_id, rank, doc_id, score) of each distinct item."""
    counted = [(name, Counter(plain_terms(text))) for name, text in docs]
    counted = [(name, c, sum(c.values())) for name, c in counted if c]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for name, c, n in counted:
            m = 100 - 75 + (75 * n * n_docs) // total
            score = 0
            for t in plain_terms(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, name is None, name or 0))
        for rank, (score, nameless, name) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if nameless else name, -score))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ITEMS = [
    (1, prose(1, 12)), (1, prose(1, 12)), (2, prose(4, 30) + " the the"), (3, None), (4, ""), (5, "no such words"), (6, "MIT License mit ÉÀ é"),
    (7, prose(8, 300)), (None, "line"), (8, "one TWO"), (8, "three"),
]


@pytest.mark.parametrize("chunk_terms, top", [(200_000, 10), (40, 10), (1, 2)])
def test_search_is_that_of_a_plain_scorer(spark, docs, messy, chunk_terms, top):
    items = spark.createDataFrame([(i, t, "x", 3) for i, t in ITEMS], "item_id long, text string, score string, rank int")
    got = found(lexical.search(docs, items, top=top, chunk_terms=chunk_terms))
    assert got == plain_search([(r[0], r[1]) for r in messy], ITEMS, top)


def test_ties_blocks_and_many_tasks(spark):
    """600 documents, many alike, in blocks of 16: bounds of earlier blocks stop accumulators in later ones."""
    rows = [(k * 7 % 600, prose(k % 40, 30) + (" rare" if k % 97 == 0 else "")) for k in range(600)]
    items = [(k, prose(k, 8) + " rare") for k in range(30)]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = found(lexical.search(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert got == plain_search(rows, items)


def test_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical.search(empty, items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0


@given(st.integers(0, 10**6), st.integers(1, 6), st.integers(0, 3))
@settings(max_examples=150, deadline=None)
def test_accumulators_are_exact_where_they_matter(seed, top, bound):
    random = np.random.default_rng(seed)
    n_docs, n_terms = 40, 12
    sizes = random.integers(0, n_terms + 1, n_docs)
    terms = np.concatenate([np.sort(random.choice(n_terms, k, replace=False)) for k in sizes])
    times = random.integers(1, 5, len(terms))
    n = np.array([int(times[a:b].sum()) for a, b in zip(np.cumsum(sizes) - sizes, np.cumsum(sizes))])
    block = lexical.postings(n, sizes, terms, times, n_terms, n_docs, int(n.sum()))
    asked = random.permutation(n_terms)[:8]
    weights = random.integers(1, 4000, 8) ** 2
    exact = np.zeros(n_docs, np.int64)
    for t, w in zip(asked, weights):
        here = slice(block.first[t], block.first[t + 1])
        exact[block.doc[here]] += w * block.part[here]
    least = int(np.sort(exact)[-1 - bound]) if bound else 0
    scores, _ = lexical.accumulate(block, asked, weights, top, least)
    assert (scores <= exact).all()
    kth = max(np.sort(exact)[-top], least)
    assert (scores[exact >= kth] == exact[exact >= kth]).all()


def test_accumulators_stop():
    """A rare term settles the best documents before the frequent one is reached."""
    terms = np.array([0, 1] * 5 + [1] * 95)
    sizes = np.array([2] * 5 + [1] * 95)
    block = lexical.postings(sizes.astype(np.int64), sizes, terms, np.ones(len(terms), int), 2, 100, len(terms))
    scores, stopped = lexical.accumulate(block, np.array([0, 1]), np.array([5000, 10]), 5)
    assert stopped == 1 and (scores[:5] > 0).all() and not scores[5:].any()
