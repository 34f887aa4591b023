"""Near-duplicates, repeated strings and vectors against brute force."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from llm.conftest import SCHEMA, prose, row
from millrace.llm import classifier, graph, near, suffixes, vectors


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(100, 160)] + [(0, k) for k in range(1, 50)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    found = graph.components(spark.createDataFrame(links + [(None, 4), (7, 7)], "u long, v long")).collect()
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.component for r in found} == roots(nodes, links)
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def word_sets(text, size):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(docs, messy, size):
    sets = {r[0]: word_sets(r[1], size) for r in messy if r[0] is not None}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = roots(sets, links)
    assert any(a != b for a, b in want.items())
    found = near.near_duplicates(docs, near.Settings(size=size)).collect()
    assert len(found) == len(messy)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_duplicates_in_chains(spark):
    """Copies that drift: neighbours are linked, the ends are not."""
    rng = random.Random(5)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for k in range(40):
        rows.append((k, " ".join(words)))
        words = list(words)
        words[(7 * k) % 120] = f"n{k}"
    sets = {k: word_sets(t, 4) for k, t in rows}
    links = [(a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for block in (4, 512):
        found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), near.Settings(block=block)).collect()
        assert {r.doc_id: r.component_id for r in found} == roots(sets, links)


def drifting(n, seed, changes):
    """Near copies of one text of which many pairs lie close to the threshold, on both sides."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for k in range(n):
        words = list(base)
        for at in rng.sample(range(100), changes):
            words[at] = f"n{rng.randint(0, 10**9)}"
        rows.append((k, " ".join(words)))
    return rows


@pytest.mark.parametrize("n, changes, block", [(3000, 2, 512), (3000, 2, 64), (600, 2, 16)])
def test_large_groups_of_near_copies(spark, n, changes, block, monkeypatch):
    """Blocks pass on links that join components, not pairs, and no link is lost."""
    rows = drifting(n, n, changes)
    codes = [np.sort(np.array([hash(x) for x in word_sets(t, 4)])) for _, t in rows]
    names = {v: k for k, v in enumerate(sorted({v for c in codes for v in c.tolist()}))}
    held = np.zeros((n, len(names)), np.float32)
    for k, c in enumerate(codes):
        held[k, [names[v] for v in c.tolist()]] = 1
    sizes = held.sum(1)
    links = []
    for k in range(n):
        common = held[k + 1 :] @ held[k]
        links += [(k, k + 1 + j) for j in np.flatnonzero(100 * common >= 80 * (sizes[k] + sizes[k + 1 :] - common)).tolist()]
    assert n < len(links) < n * (n - 1) / 2
    passed = []
    real = near._across
    monkeypatch.setattr(near, "_across", lambda *a, **b: passed.append(real(*a, **b)) or passed[-1])
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), near.Settings(block=block)).collect()
    assert {r.doc_id: r.component_id for r in found} == roots({k: 1 for k, _ in rows}, links)
    assert sum(p.count() for p in passed) < 24 * 2 * n


def test_pruning_loses_few_links():
    settings = near.Settings()
    assert near.pruning_loss(0.8, settings) < 1e-5 and near.pruning_loss(0.85, settings) < 1e-7
    rng = np.random.default_rng(1)
    loose = near.Settings(miss=1e-2)
    a = rng.integers(0, 256, (20_000, 256), dtype=np.uint8)
    b = np.where(rng.random(a.shape) < 0.8, a, rng.integers(0, 256, a.shape, dtype=np.uint8))
    lost = 1 - len(near.surviving(a, b, loose)[0]) / len(a)
    assert abs(lost - near.pruning_loss(0.8, loose)) < 0.005


def test_texts_that_share_an_id(spark):
    a, b = prose(21, 120), prose(22, 120)
    words = b.split(" ")
    near_b = " ".join([*words[:60], "changed", *words[61:]])
    rows = [row(5, a), row(5, b), row(5, b), row(5, near_b), row(9, a), row(8, near_b), row(6, prose(23, 50)), row(5, ""), row(5, None)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = near.near_duplicates(table, near.Settings(size=5)).collect()
    assert len(found) == len(rows) and all(r.component_id == 5 for r in found if r.doc_id != 6)
    assert not any(r.kept for r in found if r.doc_id in (8, 9))  # linked with either text of id 5
    left = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, table, "").collect()]
    assert len(left) == len(set(left)) == 5 and {(5, a), (6, prose(23, 50)), (5, ""), (5, None)} < set(left)
    assert ((5, b) in left) != ((5, near_b) in left)


def test_near_duplicates_of_nothing(empty):
    assert near.near_duplicates(empty).count() == 0


def test_posterior_bounds():
    settings = near.Settings()
    assert near.bands_miss(0.8, settings) < 1e-5
    for n in (32, 64, 128):
        least = near.least_matches(n, 0.8, settings.miss)
        chance = sum(np.exp(sum(np.log((n - k) / (k + 1)) for k in range(m)) + m * np.log(0.8) + (n - m) * np.log(0.2)) for m in range(least))
        assert chance < 1e-2
    a = np.zeros((3, 256), np.uint8)
    b = a.copy()
    b[1] = 1
    b[2, ::10] = 1
    assert near.surviving(a, b, settings)[0].tolist() == [0, 2]


def brute_spans(texts, length):
    places = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            places.setdefault(t[i : i + length], []).append((d, i))
    out = [[False] * len(t) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                out[d][i : i + length] = [True] * length
    return out


@pytest.mark.parametrize("length, gram, hot", [(200, 50, 20_000), (40, 12, 20_000), (40, 12, 2)])
def test_repeated_spans(docs, messy, length, gram, hot):
    texts = [(r[1] or "").encode() for r in messy]
    want = []
    for r, t, cover in zip(messy, texts, brute_spans(texts, length)):
        kept = bytes(b for b, c in zip(t, cover) if not c)
        runs = sum(c and not p for c, p in zip(cover, [False, *cover]))
        want.append((r[0] or 0, len(t), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    found = suffixes.repeated_spans(docs, suffixes.Settings(length, gram, hot)).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == sorted(want)
    assert any(0 < w[2] < w[1] for w in want)


def test_ranges_are_bounded_when_many_suffixes_begin_alike(spark, monkeypatch):
    """Half of the anchors begin with the same blanks, but their k-grams differ."""
    rng = random.Random(5)
    passages = [(" " * 20).join(f"{rng.randrange(10**4):04}" for _ in range(400)) for _ in range(12)]
    table = spark.createDataFrame([(k, f"{k} {passages[k % 12]} {k}") for k in range(24)], "doc_id long, text string").repartition(3)
    sizes, merged = [], suffixes._merged

    def spy(runs, settings):
        sizes.extend(r["sum(n)"] for r in runs.groupBy("range").sum("n").collect())
        return merged(runs, settings)

    monkeypatch.setattr(suffixes, "RECORDS_PER_RANGE", 200)
    monkeypatch.setattr(suffixes, "_merged", spy)
    found = suffixes.repeated_spans(table).collect()
    assert sum(sizes) > 1500 and max(sizes) <= 400
    assert all(r.n_removed >= len(passages[r.doc_id % 12].encode()) for r in found)


def test_small_ranges_runs_and_many_tasks(spark, messy, monkeypatch):
    """Ranges of 100 records from runs of 30, of twelve tasks and few samples, give what one range gives."""
    for name, value in (("RECORDS_PER_RANGE", 100), ("RECORDS_PER_RUN", 30), ("MOST_SAMPLES", 50)):
        monkeypatch.setattr(suffixes, name, value)
    rows = [(k, r[1] or "") for k, r in enumerate(messy)] + [(100 + k, prose(k % 30, 120) + prose(k, 20)) for k in range(90)]
    runs = []
    real = suffixes._runs
    monkeypatch.setattr(suffixes, "_runs", lambda *a: runs.append(real(*a)) or runs[-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    found = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in suffixes.repeated_spans(docs, suffixes.Settings(60, 20)).collect()}
    for (k, text), cover in zip(rows, brute_spans([t.encode() for _, t in rows], 60)):
        assert [b for a, e in found[k] for b in range(a, e)] == [b for b, c in enumerate(cover) if c]
    sizes = runs[0].groupBy("range").agg({"n": "sum"}).collect()
    assert len(sizes) > 10 and max(r.n for r in runs[0].select("n").collect()) <= 30


def test_long_texts_in_one_batch(spark):
    """A few texts of several MB each, which come in one batch, are cut apart before they become Python objects."""
    from millrace.llm.encoding import by_size

    passage = prose(5, 80)
    rows = [(k, prose(k, 150_000) + passage + prose(90 + k, 20)) for k in range(6)] + [(6, None), (7, ""), (8, "x")]
    batch = pa.RecordBatch.from_pydict({"doc_id": [k for k, _ in rows], "text": [t for _, t in rows]})
    parts = list(by_size([batch], most=1 << 20))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    longest = max(len((t or "").encode()) for _, t in rows)
    assert len(parts) >= 4 and all(sum(len((t or "").encode()) for t in p.column("text").to_pylist()) <= (1 << 20) + longest for p in parts)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r.doc_id: r for r in suffixes.repeated_spans(docs).collect()}
    for k in range(6):
        start = len(prose(k, 150_000).encode())
        assert any(s.start <= start and s.end >= start + len(passage.encode()) for s in found[k].spans)
    near_found = {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect()}
    assert near_found == {k: k for k in range(9)}


def test_remove_repeated_keeps_all_columns(docs, messy, empty):
    found = suffixes.remove_repeated(docs).collect()
    assert len(found) == len(messy) and found[0].asDict().keys() == set(docs.columns)
    texts = {r.doc_id: r.text for r in found}
    assert texts[5] is None and texts[6] == "" and texts[17] == messy[-1][1] and len(texts[11]) < len(messy[13][1])
    assert suffixes.remove_repeated(empty).count() == 0 and suffixes.repeated_spans(empty).count() == 0


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(7)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 40))) for _ in range(7)]

    def coded(run):
        shared, rests = suffixes.front_coded(run)
        return iter([(int(n), rest, k) for k, (n, rest) in enumerate(zip(shared, rests))])

    got = list(suffixes.merge([coded(r) for r in runs]))
    keys = [key for _, key, _, _ in got]
    assert keys == sorted(k for r in runs for k in r)
    assert all(runs[run][tag] == key for _, key, run, tag in got)
    for (_, x, _, _), (n, y, _, _) in zip(got, got[1:]):
        assert n == suffixes.common_prefix(x, y)


def brute_vectors(rows, threshold):
    good = {}
    for number, v, label in rows:
        if number is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[number] = (label, np.array(v, float))
    links = []
    for a, b in combinations(good, 2):
        (la, x), (lb, y) = good[a], good[b]
        if la == lb and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
            links.append((a, b))
    return links


def test_vectors(spark):
    rng = np.random.default_rng(2)
    rows, centre = [], rng.normal(size=(4, 8))
    for k in range(120):
        v = centre[k % 4] + rng.normal(size=8) * 0.12
        rows.append((k, [float(x) for x in v.astype(np.float32)], None if k == 50 else int(k % 4 > 1)))
    rows += [(200 + k, rows[7][1], rows[7][2]) for k in range(3)]
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 8, 1), (303, [float("nan")] * 8, 1), (304, [None] + [1.0] * 7, 1), (305, [1.0, 2.0], 1), (None, rows[7][1], rows[7][2])]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, rep string, v int")
    links = brute_vectors(rows, 0.98)
    want = roots([r[0] for r in rows if r[0] is not None], links)
    assert len(links) > 50
    for tile in (16, 2048):
        found = vectors.near_duplicates(table, tile=tile).collect()
        assert len(found) == len(rows)
        for r in found:
            n = sum(r.vec_id in pair for pair in links)
            assert (r.n_links, r.component_id) == (n, want.get(r.vec_id)) and r.kept == (want.get(r.vec_id) == r.vec_id)
    assert vectors.near_duplicates(table.where("false")).count() == 0


def test_quantisation_bounds_hold():
    x = np.random.default_rng(4).normal(size=(60, 64))
    codes, scale, norm, error = vectors.encode(x)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    approximate = (codes * scale[:, None]) @ (codes * scale[:, None]).T
    assert (np.abs(unit @ unit.T - approximate) <= norm[:, None] * error[None] + error[:, None] + 1e-12).all()


def test_vectors_of_extreme_length_are_linked(spark):
    base = np.random.default_rng(2).normal(size=16)
    other = np.random.default_rng(3).normal(size=16)
    scales = [1.0, 1e200, 1e-200, 1e300, 3e-308]
    rows = [(k, (base * s).tolist(), "a") for k, s in enumerate(scales)] + [(10 + k, (other * s).tolist(), "a") for k, s in enumerate(scales[:3])]
    found = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == {k: (4, 0) for k in range(5)} | {10 + k: (2, 10) for k in range(3)}


def test_stages_pass_columns_of_any_name(spark, messy):
    """Columns named as those that the stages use inside come out as they went in."""
    names = SCHEMA + ", __score double, __digest string, __spans int, __copy string, __Copy_ int"
    rows = [(*r, 0.25, f"d{k}", k, "c", -k) for k, r in enumerate(messy)]
    table = spark.createDataFrame(rows, names).repartition(3)
    unique = corpus_pipeline.near_duplicates(spark, table, "")
    cleaned = suffixes.remove_repeated(table)
    scored = classifier.score(table, classifier.train(table, spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")), keep="mine")
    for out in (unique, cleaned, scored.drop("mine")):
        assert out.columns == table.columns
        assert {(r["__digest"], r["__spans"], r["__copy"], r["__Copy_"]) for r in out.collect()} <= {(f"d{k}", k, "c", -k) for k in range(len(rows))}
    assert cleaned.count() == len(rows)
    with pytest.raises(ValueError, match="there is a column"):
        classifier.score(table, None, keep=True)
