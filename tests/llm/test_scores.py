"""Classifiers, rules, licences and mixing against plain versions and known answers."""

import random
import re
import textwrap
from collections import Counter

import numpy as np
import pytest

from millrace.llm import classifier, crf, licenses, mixing, rules, toxicity, trees
from millrace.llm.queries import QUERIES
from millrace.llm.spans import ALNUM, WHITE, hashes, words_of


def test_words_and_hashes(messy):
    texts = [r[1] for r in messy]
    words = words_of(texts, ~WHITE)
    found = [words.data[a:b].tobytes() for a, b in zip(words.start, words.end)]
    assert found == [w for t in texts for w in (t or "").encode().split()]
    assert np.diff(words.first).tolist() == [len((t or "").encode().split()) for t in texts]
    codes = {}
    for w, h in zip(found, hashes(words).tolist()):
        assert codes.setdefault(w, h) == h
    assert len(set(codes.values())) == len(codes)


def plain_marginals(emission, transition):
    weight, out = np.exp(transition), []
    forward = [np.array([1.0, 0.0])]
    for e in emission:
        forward.append((forward[-1] @ weight) * np.array([1.0, np.exp(e)]))
        forward[-1] /= forward[-1].sum()
    back = np.ones(2)
    for k in range(len(emission) - 1, -1, -1):
        p = forward[k + 1] * back
        out.append(p[1] / p.sum())
        back = weight @ (np.array([1.0, np.exp(emission[k])]) * back)
        back /= back.sum()
    return out[::-1]


def test_marginals_are_those_of_the_plain_recursion():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 63, 64, 65, 0, 300, 5]
    first = np.concatenate([[0], np.cumsum(sizes)])
    emission, transition = rng.normal(size=first[-1]) * 3, rng.normal(size=(2, 2))
    want = np.concatenate([plain_marginals(emission[a:b], transition) for a, b in zip(first, first[1:])])
    assert np.allclose(crf.marginals(emission, first, transition), want)


def clean_text(rng, n=60):
    return " ".join("".join(rng.choice(["an", "er", "th", "on", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def toxic_corpus(n):
    rng, texts, labels = random.Random(2), [], []
    for k in range(n):
        words = clean_text(rng).split(" ")
        if k % 3 == 0:
            for _ in range(4):
                words[rng.randint(0, len(words) - 1)] = rng.choice(["vile", "Wretch!!", "oaf,"])
        texts.append(" ".join(words))
        labels.append(float(k % 3 == 0))
    return texts, np.array(labels)


def test_toxic_spans_and_scores_on_held_out_texts():
    texts, labels = toxic_corpus(300)
    model = toxicity.fit(texts[:200], labels[:200], labels.mean())
    scores, spans = toxicity.score_texts(model, texts[200:], 0.5)
    assert ((scores >= 0.3) == labels[200:]).mean() > 0.97
    for text, found in zip(texts[200:], spans):
        want = {m.span() for m in re.finditer(r"\b(vile|wretch|oaf)\b", text, re.I)}
        assert {k for s in found for k in range(s["start"], s["end"])} >= {k for a, b in want for k in range(a, b)}


def test_offsets_are_code_points():
    texts, labels = toxic_corpus(200)
    model = toxicity.fit(texts, labels, 0.3)
    text = "éß 日本 vile ñ"
    assert [text[s["start"] : s["end"]] for s in toxicity.score_texts(model, [text], 0.5)[1][0]] == ["vile"]


def test_scores_of_messy_rows(docs, messy, empty, spark):
    texts, labels = toxic_corpus(120)
    model = toxicity.fit(texts, labels, 0.3)
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(messy) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (5, 6, 7)}) == 1
    assert toxicity.score(empty, model).count() == 0
    labelled = spark.createDataFrame([(1, 1, 1), (3, 0, None), (None, 1, 0), (999, 0, 1)], "doc_id long, toxic int, quality int")
    assert 0 <= toxicity.score(docs, toxicity.train(docs, labelled)).first().score <= 1
    nothing = toxicity.train(empty, labelled.where("false"))
    assert toxicity.score(docs, nothing).count() == len(messy)
    forest = classifier.train(docs, labelled)
    assert classifier.score(docs, forest).count() == len(messy) and classifier.score(empty, forest).count() == 0
    kept = classifier.score(docs, classifier.train(empty, labelled), keep=True)
    assert kept.columns == [*docs.columns, "__score"] and kept.count() == len(messy)
    assert docs.columns == kept.columns[:-1]


def plain_margin(forest, x):
    total = forest.base
    for root in forest.roots:
        k = root
        while forest.left[k]:
            k = forest.left[k] + int(x[forest.feature[k]] > forest.threshold[k])
        total += forest.value[k]
    return total


def test_trees():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    forest = trees.train(x[:2000], y[:2000])
    assert ((forest.probabilities(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95
    assert np.allclose(forest.margins(x[:50]), [plain_margin(forest, r) for r in x[:50]])
    assert np.allclose(trees.train(x[:10], np.ones(10)).probabilities(x[:3]), 11 / 12)
    assert trees.train(x[:0], y[:0]).probabilities(x[:2]).tolist() == [0.5, 0.5]


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    times, marked = Counter(windows), [False] * len(words)
    for k, w in enumerate(windows):
        if times[w] > 1:
            marked[k : k + 8] = [True] * 8
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), sum(marked)


def test_rules_counts_and_ratio(docs, messy, empty):
    trusted = docs.where("doc_id in (1, 11, 13)")
    ratio = rules.train(docs, trusted)
    found = rules.apply(docs, ratio).collect()
    by_text = {r[0]: r[1] for r in messy}
    for r in found:
        if r.doc_id is not None:
            want = plain_counts(by_text[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
            assert r.kept == (not r.base_failed and r.ratio >= rules.MIN_RATIO)
    # the ratio once more, from buckets counted word by word
    def buckets(text):
        codes = hashes(words_of([text], rules.WHITE_OUT))
        pairs = codes[:-1] * rules._PAIR + codes[1:]
        return ((np.concatenate([codes, pairs]) * rules._MIX) >> np.uint64(64 - rules.BUCKET_BITS)).astype(int)

    raw, target = np.zeros(1 << rules.BUCKET_BITS), np.zeros(1 << rules.BUCKET_BITS)
    for number, text, *_ in messy:
        np.add.at(raw, buckets(text), 1)
        if number in (1, 11, 13):
            np.add.at(target, buckets(text), 1)
    share = (raw + 1) / (raw + 1).sum()
    weights = np.log((target + len(raw) * share) / (target.sum() + len(raw))) - np.log(share)
    assert np.allclose(ratio.weights, weights)
    for r in found:
        if r.doc_id in (3, 11, 15):
            assert np.isclose(r.ratio, weights[buckets(by_text[r.doc_id])].mean())
    assert rules.apply(empty, rules.train(empty, empty)).count() == 0


def test_rules_give_the_same_verdict_in_a_larger_corpus(spark, tmp_path):
    """Documents of words of their own stay rejected, and clean ones kept, when other documents fill the buckets."""
    rng = np.random.default_rng(3)

    def text(k):
        own = k % 3 == 0
        return " ".join(f"{k}x{x}" if own else f"w{x}" for x in (rng.integers(0, 1000, 200) if own else rng.zipf(1.3, 200) % 5000))

    texts = [text(k) for k in range(9000)]
    verdicts = []
    for n in (300, 9000):
        folder = f"{tmp_path}/{n}"
        spark.createDataFrame([(k, texts[k]) for k in range(n)], "doc_id long, text string").repartition(4).write.parquet(f"{folder}/documents.parquet")
        good = [(k, int(k % 3 > 0)) for k in range(n) if k % 2]
        spark.createDataFrame(good, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
        verdicts.append({r.doc_id: r.kept for r in QUERIES["op7_quality_rules"](spark, folder).collect() if r.doc_id < 300})
    for found in verdicts:
        assert not any(found[k] for k in range(0, 300, 3))
        assert np.mean([found[k] for k in range(300) if k % 3]) > 0.9
    assert np.mean([verdicts[0][k] == verdicts[1][k] for k in range(300)]) > 0.95
    docs = spark.read.parquet(f"{tmp_path}/9000/documents.parquet")
    assert 9000 * 399 / len(rules.train(docs, docs.limit(0)).weights) < 100  # n-grams a bucket
    assert [rules.bits_for(n) for n in (0, 192 << 18, 192 << 20, 192 << 30)] == [rules.BUCKET_BITS, 18, 20, rules.MOST_BITS]
    # a model at its bound: 875 n-grams share a bucket, as in 2**20 buckets for some five GB of text
    trusted = spark.read.parquet(f"{tmp_path}/9000/labels.parquet").where("quality = 1").select("doc_id")
    full = {r.doc_id: r.kept for r in rules.judge(docs, trusted, bits=12).where("doc_id < 300").collect()}
    assert not any(full[k] for k in range(0, 300, 3))
    assert np.mean([verdicts[0][k] == full[k] for k in range(300)]) > 0.95


def test_the_least_ratio_is_exact_and_repeatable(spark):
    rows = [(k, (k * 37 % 1000) / 4096 - 0.1, k % 50 == 0) for k in range(1000)]
    scored = spark.createDataFrame(rows, "doc_id long, ratio double, base_failed boolean")
    trusted = spark.range(0, 2000, 2).toDF("doc_id")
    known = sorted(ratio for k, ratio, failed in rows if not failed and k % 2 == 0)
    for share in (0.0, 0.01, 0.5):
        found = {rules.trusted_floor(scored.repartition(n), trusted, share) for n in (1, 7)}
        exact = known[int(share * len(known))]
        assert len(found) == 1 and exact - 1 / rules.STEPS < found.pop() <= exact
    assert rules.trusted_floor(scored, trusted.limit(0)) == rules.MIN_RATIO


def plain_scan(text, templates, threshold):
    out = []
    lines = (text or "").split("\n")
    units = [("line", k, x) for k, x in enumerate(lines)] + ([("document", None, text)] if len(lines) > 1 else [])
    for unit, k, body in units:
        grams = licenses.bigrams_of(licenses.normal_words(body))
        for name, template in templates.items():
            other = licenses.bigrams_of(licenses.normal_words(template))
            common = len(grams & other)
            if grams and 2 * common >= threshold * (len(grams) + len(other)):
                out.append((unit, k, name, common, len(grams), len(other)))
    return out


def test_licenses(spark, empty):
    rng = random.Random(4)
    words = " ".join(licenses.TEMPLATES.values()).split(" ")
    texts = [None, "", " ", "x", *licenses.TEMPLATES.values()]
    for name, text in licenses.TEMPLATES.items():
        parts = text.split(" ")
        for _ in range(6):
            changed = [rng.choice(words) if rng.random() < 0.08 else w for w in parts]
            texts.append("intro\n" + " ".join(changed).upper() + "\n" + clean_text(rng, 20))
            texts.append(" ".join(changed[:5]) + "\n" + " ".join(changed[5:]))
    texts += ["Released under the MIT License. " * 3, "ÀÉ ñ Released under the MIT-License"]
    table = spark.createDataFrame([(k, t, 1, "z") for k, t in enumerate(texts)], "doc_id long, text string, common int, license string")
    for threshold in (0.6, 0.8):
        found = licenses.scan(table, threshold=threshold).collect()
        want = [(k, *r) for k, t in enumerate(texts) for r in plain_scan(t, licenses.TEMPLATES, threshold)]
        got = [(r.doc_id, r.unit, r.line_no, r.license, r.common, r.n_unit, r.n_template) for r in found]
        assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(want) > 50
    assert licenses.scan(empty).count() == 0 and licenses.scan(table, {}).count() == 0


def plain_passages(text, templates, threshold):
    words, out = licenses.normal_words(text or ""), set()
    for name, body in templates.items():
        other = licenses.normal_words(body)
        wanted = licenses.bigrams_of(other)
        rare = licenses.anchors(wanted, threshold / (2 - threshold))
        for k in range(len(words) - 1):
            for at in range(len(other) - 1):
                if words[k : k + 2] == other[at : at + 2] and " ".join(words[k : k + 2]) in rare:
                    window = words[max(k - at, 0) : k - at + len(other)]
                    grams = licenses.bigrams_of(window)
                    common = len(grams & wanted)
                    if 2 * common >= threshold * (len(grams) + len(wanted)):
                        out.add((max(k - at, 0), len(window), name, common, len(grams), len(wanted)))
    return out


def test_wrapped_and_embedded_notices(spark, empty):
    rng = random.Random(8)
    mit = "MIT License\n\nCopyright (c) 2020 Someone\n\n" + textwrap.fill(licenses.PASSAGES["mit-text"], 78) + "\n"
    apache = textwrap.fill(licenses.TEMPLATES["apache-2.0-notice"], 60, initial_indent=" * ", subsequent_indent=" * ")
    gpl = textwrap.fill(licenses.TEMPLATES["gpl-3.0-notice"], 70, initial_indent="# ", subsequent_indent="# ")
    want = [
        (mit, "mit-text"), (mit, "mit-grant"), (clean_text(rng, 300) + "\n" + apache + "\n" + clean_text(rng, 300), "apache-2.0-notice"),
        (gpl + "\n" + clean_text(rng, 200), "gpl-3.0-notice"), ("This file is released under the MIT License.", "mit"),
        ("All parts are Licensed under the MIT License. " + clean_text(rng, 40), "mit-licensed"),
    ]
    others = [None, "", "x", clean_text(rng, 50), "License version licensed", *licenses.PASSAGES.values()]
    others += [" ".join(w for w in t.split() if rng.random() > 0.06) for t in licenses.PASSAGES.values()]
    texts = [t for t, _ in want] + others
    table = spark.createDataFrame([(k, t, 1, "z") for k, t in enumerate(texts)], "doc_id long, text string, common int, license string")
    found = licenses.passages(table).collect()
    for k, (_, name) in enumerate(want):
        assert any(r.doc_id == k and r.license == name for r in found)
    got = sorted((r.doc_id, r.first_word, r.n_words, r.license, r.common, r.n_unit, r.n_template) for r in found)
    assert got == sorted((k, *x) for k, t in enumerate(texts) for x in plain_passages(t, licenses.PASSAGES, licenses.THRESHOLD))
    assert licenses.passages(empty).count() == 0 and licenses.passages(table, {}).count() == 0
    assert licenses.passages(spark.createDataFrame([("a b",), ("a",)], "text string").selectExpr("1L AS doc_id", "text"), {"one": "A."}).count() == 2
    rows = licenses.scan(table).collect()  # lines and whole documents miss them
    assert not any(r.doc_id < 4 and r.license == want[r.doc_id][1] for r in rows)


def language(rng, parts, n=40):
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 2))) for _ in range(n))


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(6)
    kinds = {"a": ["ka", "ko", "mi"], "b": ["zu", "po", "ly"], "c": ["fe", "gra", "du"]}
    rows = [(k, language(rng, kinds[d], rng.randint(5, 80)), d) for k, d in enumerate(rng.choices("abc", [7, 2, 1], k=300))]
    rows += [(300, None, "a"), (301, "", "b"), (None, rows[0][1], "a"), (5, rows[5][1], rows[5][2])]
    return spark.createDataFrame(rows, "doc_id long, text string, domain string")


def test_mixing_reaches_targets(tongues):
    targets = {"a": 0.4, "b": 0.3, "c": 0.3}
    model = mixing.train(tongues, tongues.where("doc_id % 2 = 0"), "domain", list(targets))
    found = mixing.mix(tongues, model, targets).collect()
    p = np.array([r["__p"] for r in found])
    n, rate = np.array([r["__tokens"] for r in found]), np.array([r["__rate"] for r in found])
    assert len(found) == 304 and (rate >= 0).all() and np.allclose(p.sum(1), 1)
    long = n >= 20
    assert (np.array(list("abc"))[p[long].argmax(1)] == np.array([r.domain for r in found])[long]).mean() > 0.97
    totals = (n * rate) @ p
    assert np.allclose(totals / totals.sum(), [0.4, 0.3, 0.3], atol=1e-3)
    # the same steps with plain numbers
    natural = n @ p
    wanted = np.array([0.4, 0.3, 0.3]) * 1.02 * (natural / [0.4, 0.3, 0.3]).max()
    plain = np.ones(len(n))
    for _ in range(40):
        if (np.abs((n * plain) @ p - wanted) <= 1e-5 * wanted.sum()).all():
            break
        plain = np.maximum(0, plain - p @ (((n * plain) @ p - wanted) / natural))
    assert np.allclose(rate, plain, atol=1e-5)
    copies = np.array([r["__copies"] for r in found])
    assert ((copies == np.floor(rate)) | (copies == np.ceil(rate))).all()
    repeated = mixing.repeated(mixing.mix(tongues, model, targets), tongues.columns)
    assert repeated.count() == copies.sum() and repeated.columns == tongues.columns


def test_mixing_without_enough(tongues):
    model = mixing.train(tongues, tongues.where("false"), "domain", ["a", "b"])
    assert {tuple(r["__p"]) for r in mixing.with_posteriors(tongues, model).collect()} == {(0.5, 0.5)}
    assert mixing.mix(tongues.where("false"), model, {"a": 1.0, "b": 1.0}).count() == 0
    scored = mixing.mix(tongues.where("doc_id = 300"), model, {"a": 1.0, "b": 1.0}).collect()
    assert [(r["__rate"], r["__tokens"]) for r in scored] == [(1.0, 0)]
