"""Soft-membership mixing: domain posteriors of documents, and nonnegative document rates whose expected domain token totals
match targets.

A multinomial naive Bayes over hashed words, counted on a labelled table, gives p(domain | document). Rates r minimise
sum over domains of (S_d - T_d)^2 / N_d with S_d = sum_i r_i n_i p_id, N_d the natural totals and T_d the targets, by
projected gradient: r_i <- max(0, r_i - sum_d p_id (S_d - T_d) / N_d), a step of one in coordinates scaled by 1 / n_i. It
cannot diverge, as the matrix of sum_i n_i p_id p_ie / N_e has eigenvalues from 0 to 1. Each step is one aggregate over all
documents; rates are an expression of the residuals so far, so nothing but one number for each domain reaches the driver.
Only DataFrame functions are used.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import cut

BUCKETS = 4096
SAMPLE_ROWS = 8_000
EVIDENCE_WORDS = 30
_HASHES = 1 << 32


@dataclass
class Domains:
    """Log priors, and log probabilities of each bucket, by domain."""

    names: list[str]
    priors: list[float]
    words: list[list[float]]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def train(
    docs: DataFrame, labelled: DataFrame, domain: str, domains: list[str], rows: int = SAMPLE_ROWS, id_column: str = "doc_id",
    text_column: str = "text", smoothing: float = 0.5,
) -> Domains:
    """Count words of at most `rows` labelled documents, chosen by a hash of the id, per domain. The driver gets at most one
    number for each of BUCKETS buckets and domain. Null ids and other domains are left out; without labelled documents all
    domains are equally likely."""
    known = labelled.select(F.col(id_column).alias("__id"), F.col(domain).cast("string").alias("__domain"))
    known = known.where(F.col("__domain").isin(domains) & F.col("__id").isNotNull()).groupBy("__id").agg(F.min("__domain").alias("__domain"))
    sample = known.orderBy(F.xxhash64("__id"), "__id").limit(rows)
    texts = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text"))
    words = texts.join(F.broadcast(sample), "__id").select("__domain", F.explode(_words(F.col("__text"))).alias("__word"))
    counts = {d: [0] * BUCKETS for d in domains}
    for name, bucket, n in words.groupBy("__domain", _bucket(F.col("__word")).alias("__bucket")).count().collect():
        counts[name][bucket] = n
    share = {name: n for name, n in sample.groupBy("__domain").count().collect()}
    total = sum(share.values()) + len(domains)
    priors = [math.log((share.get(d, 0) + 1) / total) for d in domains]
    words_of = [[math.log((c + smoothing) / (sum(counts[d]) + smoothing * BUCKETS)) for c in counts[d]] for d in domains]
    return Domains(domains, priors, words_of)


def with_posteriors(docs: DataFrame, model: Domains, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of `docs`, and __tokens (words of the text), __p (posteriors, in the model's order) and __draw (a number
    from 0 to 1 that follows id and text). At most EVIDENCE_WORDS words' worth of evidence counts, so memberships stay soft.
    Texts without words, null ones included, have the priors as posteriors and no tokens."""
    text = F.col(text_column).cast("string")
    buckets = F.transform(_words(text), _bucket)
    counted = docs.withColumn("__buckets", buckets).withColumn("__tokens", F.size("__buckets").cast("long"))
    scale = F.lit(1.0) / F.greatest(F.col("__tokens") / F.lit(float(EVIDENCE_WORDS)), F.lit(1.0))
    sums = []
    for prior, logs in zip(model.priors, model.words):
        # relative to the first domain: smaller numbers, and one domain costs nothing
        values = [round(a - b, 6) for a, b in zip(logs, model.words[0])]
        if any(values):
            table = F.from_json(F.lit(json.dumps(values)), "array<double>")
            total = F.aggregate("__buckets", F.lit(0.0), lambda acc, b: acc + F.get(table, b))
        else:
            total = F.lit(0.0)
        sums.append(F.lit(prior) + total * scale)
    scored = counted.withColumn("__logs", F.array(*sums)).drop("__buckets")
    powers = F.transform("__logs", lambda x: F.exp(x - F.array_max("__logs")))
    draw = F.pmod(F.xxhash64(F.col(id_column), F.xxhash64(text)), F.lit(_HASHES)) / F.lit(float(_HASHES))
    shares = F.transform("__powers", lambda x: x / F.aggregate("__powers", F.lit(0.0), lambda a, b: a + b))
    return scored.withColumn("__powers", powers).withColumns({"__p": shares, "__draw": draw}).drop("__logs", "__powers")


def _dot(values: list[float]) -> Column:
    total = F.lit(0.0)
    for k, v in enumerate(values):
        total = total + F.lit(v) * F.get("__p", F.lit(k))
    return total


def rates(
    scored: DataFrame, targets: dict[str, float], names: list[str], total: float | None = None, steps: int = 40,
    tolerance: float = 1e-5, headroom: float = 0.02,
) -> Column:
    """The rate of each row of `scored` as an expression of its posteriors.

    `targets` are weights by domain; `total` is the number of tokens wanted, by default the fewest with which no domain gets
    less than it has, and `headroom` more, as memberships are soft and rates of one domain differ a little. Steps end when every total is within `tolerance` of the wanted total. Domains with no tokens cannot be
    reached and keep their residual; without any tokens all rates are 1.
    """
    n = len(names)
    rate = F.lit(1.0)

    def totals(value: Column) -> list[float]:
        sums = [F.round(F.sum(value * F.col("__tokens") * F.get("__p", F.lit(k))), 3).alias(f"s{k}") for k in range(n)]
        return [x or 0.0 for x in scored.agg(*sums).first()]

    natural = totals(rate)
    weights = [max(targets.get(d, 0.0), 0.0) for d in names]
    if not sum(natural) or not sum(weights):
        return rate
    weights = [w / sum(weights) for w in weights]
    if total is None:
        total = (1 + headroom) * max(x / w for x, w in zip(natural, weights) if w)
    wanted = [w * total for w in weights]
    now = natural
    for _ in range(steps):
        moves = [round((s - t) / x, 9) if x else 0.0 for s, t, x in zip(now, wanted, natural)]
        if all(abs(s - t) <= tolerance * total or not x for s, t, x in zip(now, wanted, natural)):
            break
        rate = F.greatest(F.lit(0.0), rate - _dot(moves))
        now = totals(rate)
    return rate


def mix(
    docs: DataFrame, model: Domains, targets: dict[str, float], total: float | None = None, id_column: str = "doc_id",
    text_column: str = "text", keep_text: bool = True,
) -> DataFrame:
    """All columns of `docs` (without the text unless `keep_text`), and __tokens, __p, __rate and __copies: the rate rounded
    up or down by a draw that follows id and text, so that expected copies are the rate.

    Equal rows are drawn alike. Null ids are documents like others. An empty table gives no rows. Columns of `docs` may have
    any names but these.
    """
    scored = with_posteriors(docs, model, id_column, text_column)
    scored = cut(scored if keep_text else scored.drop(text_column))
    rated = scored.withColumn("__rate", rates(scored, targets, model.names, total))
    return rated.withColumn("__copies", F.floor(F.col("__rate") + F.col("__draw")).cast("int")).drop("__draw")


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of each document as many times as it has copies."""
    copies = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    return mixed.where(F.col("__copies") > 0).select(*columns, copies.alias("__copy")).drop("__copy")
