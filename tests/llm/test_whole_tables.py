"""The registered queries and the pipeline's stages on the smallest tables, against SQL, brute force and held-out labels."""

import hashlib
import os
import re
import zlib
from collections import defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest
from llm.test_dedup import brute_spans, roots, word_sets
from llm.test_scores import plain_counts
from llm.test_tokens import covered, crc, library_ids

import corpus_pipeline
from check import TABLES, compare
from millrace.llm import classifier, packing
from millrace.llm.queries import EXAMPLE_LIMITS, LANGUAGES, QUERIES, SQL, table
from millrace.session import cut

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in table(spark, FOLDER, "documents").collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES.split():
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    found = QUERIES[name](spark, FOLDER)
    result = db.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert not compare([tuple(r) for r in found.collect()], found.columns, result.fetchall(), columns)


def test_token_files(spark, texts):
    at, want = 0, {}
    for number, ids in zip(sorted(texts), library_ids("word_bpe_49k.json", [texts[k] for k in sorted(texts)])):
        want[number] = at, len(ids), crc(ids)
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op1_token_files"](spark, FOLDER).collect()} == want


def spans_of(texts):
    data = {k: t.encode() for k, t in texts.items()}
    return {k: (data[k], c) for k, c in zip(data, brute_spans(list(data.values()), 200))}


def test_repeated_strings(spark, texts):
    want = {}
    for k, (data, cover) in spans_of(texts).items():
        kept = bytes(b for b, c in zip(data, cover) if not c)
        want[k] = len(data), sum(cover), sum(c and not p for c, p in zip(cover, [False, *cover])), hashlib.sha256(kept).hexdigest()
    found = QUERIES["op2_repeated_strings"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == want


def classes(texts, size):
    sets = {k: word_sets(t, size) for k, t in texts.items()}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, roots(sets, links)


def test_near_duplicates(spark, texts):
    sets, root = classes(texts, 4)
    found = QUERIES["op3_near_duplicates"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {k: (len(sets[k]), root[k]) for k in texts}


def check_pieces(found, texts):
    """Pieces cover every copy of every text once; sequences are full or as long as a power of two."""
    encoded = dict(zip(texts, library_ids("byte_bpe_50k.json", list(texts.values()))))
    sequences, parts = defaultdict(list), defaultdict(list)
    for r in found:
        assert r.ids_crc32 == crc(encoded[r.doc_id][r.start : r.start + r.length]) and r.doc_tokens == len(encoded[r.doc_id])
        sequences[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id].append((r.start, r.length))
    sizes = [covered(s) for s in sequences.values()]
    assert max(sizes) <= 2048 and all(s & (s - 1) == 0 for s in sizes)
    return parts, encoded


def test_packing(spark, texts):
    parts, encoded = check_pieces(QUERIES["op5_packing"](spark, FOLDER).collect(), texts)
    assert {k: covered(p) for k, p in parts.items()} == {k: len(x) for k, x in encoded.items()}


def plain_packing(examples, limits):
    """The dot-product heuristic without vectors: [(tokens, loss)] to the examples' numbers by sequence, whole ones only."""
    waiting, out = dict(enumerate(examples)), []
    while waiting:
        left, taken = list(limits), []
        while left[1]:
            fits = [k for k, (n, loss) in waiting.items() if n <= left[0] and loss <= left[2]]
            if not fits:
                break
            best = max(fits, key=lambda k: (waiting[k][0] * left[0] / limits[0] ** 2 + waiting[k][1] * left[2] / limits[2] ** 2, -k))
            n, loss = waiting.pop(best)
            taken.append(best)
            left = [left[0] - n, left[1] - 1, left[2] - loss]
        out.append(taken)
    return out


def test_packing_examples_under_three_limits(spark):
    folder = FOLDER.replace("sf0.001", "sf0.01")
    turns = {(r.conv_id, r.turn): r for r in table(spark, folder, "conversations").collect()}
    found = QUERIES["op5_packing_examples"](spark, folder).collect()
    want, sizes = {}, {}
    for (conv, turn), r in turns.items():
        if r.role == "assistant":
            before = turns.get((conv, turn - 1))
            prompt = library_ids("byte_bpe_50k.json", [(before.text or "") + "\n"])[0][:-1] if before else []
            ids = prompt + library_ids("byte_bpe_50k.json", [r.text])[0]
            want[conv * 1_000_000 + turn], sizes[conv * 1_000_000 + turn] = ids, len(prompt)
    sequences, parts = defaultdict(list), defaultdict(list)
    for r in found:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == crc(ids) and r.loss_tokens == sum(k >= sizes[r.doc_id] for k in range(r.start, r.start + r.length))
        sequences[r.sequence_id].append((r.offset, r.length, r.loss_tokens))
        parts[r.doc_id].append((r.start, r.length))
    assert {k: covered(p) for k, p in parts.items()} == {k: len(x) for k, x in want.items()}
    totals = [(covered([(o, n) for o, n, _ in s]), len(s), sum(x for *_, x in s)) for s in sequences.values()]
    for k, most in enumerate(EXAMPLE_LIMITS):
        assert max(t[k] for t in totals) == most  # every limit holds, and binds


def test_packing_is_the_plain_heuristic():
    rng = np.random.default_rng(4)
    limits = packing.Limits(100, 4, 60)
    examples = []
    for k in range(150):
        n = int(rng.integers(5, 60))
        flags = np.arange(n) >= n - int(rng.integers(0, min(n, 60)))
        examples.append(packing.Example(k, np.zeros(n, np.uint32), flags, n))
    sequences, rest = packing.pack(list(examples), limits, cut=False)
    assert not rest
    assert [[x.doc for x in s] for s in sequences] == plain_packing([(len(x.ids), int(x.loss.sum())) for x in examples], (100, 4, 60))


@pytest.mark.parametrize("name, label, parts, part, cut_at", [("op6_toxicity", "toxic", 4, 2, 0.3), ("op9_quality", "quality", 3, 1, 0.5)])
def test_scores_on_held_out_labels(spark, name, label, parts, part, cut_at):
    folder = FOLDER.replace("sf0.001", "sf0.01")
    found = QUERIES[name](spark, folder).collect()
    labels = {r.doc_id: r[label] for r in table(spark, folder, "labels").collect()}
    assert len(found) == table(spark, folder, "documents").count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == part)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut_at)
    right = [r.predicted == labels[r.doc_id] for r in found if r.held_out and r.doc_id in labels]
    assert np.mean(right) > 0.9


def test_rules(spark, texts):
    for r in QUERIES["op7_quality_rules"](spark, FOLDER).collect():
        want = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.base_failed and r.kept)


def test_mixing(spark, texts):
    found = QUERIES["op4_mixing"](spark, FOLDER).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {k: len([w for w in re.split(r"[ \t\n\x0b\f\r]+", t) if w]) for k, t in texts.items()}
    totals = {d: sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in found) for d in LANGUAGES}
    for d, weight in LANGUAGES.items():
        assert abs(totals[d] / sum(totals.values()) - weight) < 1e-3


def test_pipeline_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    results = []
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, FOLDER))
        results.append(docs)
    assert all(r.columns == columns for r in results[:-1])
    good, unique, cleaned, mixed, packed = ([r.asDict() for r in x.collect()] for x in results)
    source = table(spark, FOLDER, "documents")
    forest = classifier.train(source, table(spark, FOLDER, "labels"))
    rows = {r.doc_id: r.text for r in source.collect()}
    chances = forest.probabilities(classifier.matrix(list(rows.values())))
    assert {r["doc_id"] for r in good} == {k for k, p in zip(rows, chances) if p >= 0.5}
    by_id = {r["doc_id"]: r["text"] or "" for r in good}
    _, root = classes(by_id, 5)
    assert {r["doc_id"] for r in unique} == {k for k, v in root.items() if k == v} and len(unique) == len({r["doc_id"] for r in unique})
    spans = spans_of({r["doc_id"]: r["text"] or "" for r in unique})
    for r in cleaned:
        data, cover = spans[r["doc_id"]]
        assert r["text"] == bytes(b for b, c in zip(data, cover) if not c).decode("utf-8", "ignore") and r["n_chars"] == len(r["text"])
    assert len(cleaned) == len(unique)
    copies = defaultdict(int)
    for r in mixed:
        copies[r["doc_id"]] += 1
    final = {r["doc_id"]: r["text"] or "" for r in mixed}
    assert {r["doc_id"]: r["text"] or "" for r in cleaned} == final  # nothing is thinned out
    parts, encoded = check_pieces(results[-1].collect(), final)
    for k, ids in encoded.items():
        assert sum(n for _, n in parts[k]) == copies[k] * len(ids)
    assert len(packed) == corpus_pipeline.run(spark, FOLDER).count()
