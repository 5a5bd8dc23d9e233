"""Mixing to target weights with soft domain membership.

A labelled table gives some documents a domain.  A Bernoulli naive Bayes model
over the TOKENS tokens (words, symbol runs, and classes of length and of
repetition) that tell the domains apart best predicts every document's domain
posteriors.  The counts come from all labelled rows.

Document rates r >= 0 then make the expected token totals of the domains,
``S_k = sum(n * p_k * r)``, match their targets ``T_k``: projected gradient
steps with momentum on the least squares ``sum((S_k - T_k)^2 / A_k) / 2``, where
``A_k`` is the total at rate 1.  In the metric that weighs a document by its
tokens its step is ``-sum_k p_k (S_k - T_k) / A_k``, and the largest curvature
is 1.  So all that a step needs of the corpus is one sum per domain, and a
document's rate is a function of its posteriors and the steps so far: every
iteration is one aggregation over (n, p), and nothing else is stored.

Everything runs as DataFrame expressions.
"""

from __future__ import annotations

import warnings
from functools import reduce
from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.staging import materialise

TOKENS = 96
LIFT = 2.0  # of a token's share in its most typical domain over its share in all
TEMPER = 0.5  # the naive Bayes evidence counts by this power: its tokens are not independent
ITERATIONS, TOLERANCE = 60, 1e-4
#: Shares of the expected tokens by domain of the production mix.
TARGETS = {"quality1_toxic0": 0.85, "quality0_toxic0": 0.08, "quality1_toxic1": 0.06, "quality0_toxic1": 0.01}
NO_LABELS = "all"


def _tokens(text: Column) -> Column:
    """Lower-cased words and symbol runs in text order."""
    apart = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"([!-/:-@\[-`{-~]+)", " $1 ")
    return F.array_remove(F.split(apart, r"[\x00-\x20\x7F]+"), "")


def _described(docs: DataFrame, text: Column) -> DataFrame:
    """Adds _n, the number of tokens, and _seen, the distinct ones and the
    classes of length (powers of two) and of repetition (tenths)."""
    first = docs.withColumn("_tokens", _tokens(text)).withColumn("_n", F.size("_tokens").cast("long")).withColumn(
        "_distinct", F.array_distinct("_tokens"))
    share = F.floor(10 * F.size("_distinct") / F.greatest(F.col("_n"), F.lit(1)))
    return first.withColumn("_seen", F.concat("_distinct", F.array(
        F.concat(F.lit("#length "), F.floor(F.log2(F.col("_n") + 1)).cast("string")),
        F.concat(F.lit("#distinct "), share.cast("string"))))).drop("_tokens", "_distinct")


def _fit(labelled: DataFrame, tokens: int) -> tuple[list[str], list[float], dict[str, list[float]]]:
    """Domains, their base scores, and per chosen token its weight by domain.
    ``labelled`` has domain and _seen."""
    sizes = {r["domain"]: r["n"] for r in labelled.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    domains = sorted(sizes)
    if len(domains) < 2:
        return domains or [NO_LABELS], [0.0], {}
    total = sum(sizes.values())
    # The outer form, since for the plain one the optimizer would tokenize every
    # document below the join as well, to filter out empty arrays.
    counted = labelled.select("domain", F.explode_outer("_seen").alias("token")).groupBy("token").agg(
        *[F.count(F.when(F.col("domain") == d, 1)).alias(f"c{i}") for i, d in enumerate(domains)])
    # Mutual information of the token's presence with the domain.
    held = reduce(Column.__add__, [F.col(f"c{i}") for i in range(len(domains))])

    def part(n: Column, row: Column, column: float) -> Column:
        return F.when(n > 0, n * F.log(n * total / (row * column))).otherwise(0.0)

    gain = reduce(Column.__add__, [
        part(F.col(f"c{i}"), held, sizes[d]) + part(sizes[d] - F.col(f"c{i}"), total - held, sizes[d])
        for i, d in enumerate(domains)])
    # A token must be typical of some domain: common words that merely go with a
    # language or a length would count many times over.
    lift = F.greatest(*[F.col(f"c{i}") / sizes[d] for i, d in enumerate(domains)]) / (held / total)
    best = counted.filter(F.col("token").isNotNull() & (F.col("token") != "") & (lift >= LIFT)).orderBy(gain.desc(), "token").limit(tokens).collect()  # the model: TOKENS rows
    base = [log(sizes[d] / total) for d in domains]
    weights = {}
    for r in best:
        p = [(r[f"c{i}"] + 0.5) / (sizes[d] + 1) for i, d in enumerate(domains)]
        weights[r["token"]] = [TEMPER * (log(x) - log(1 - x)) for x in p]
        base = [b + TEMPER * log(1 - x) for b, x in zip(base, p, strict=True)]
    return domains, base, weights


def domain_posteriors(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      tokens: int = TOKENS) -> tuple[DataFrame, list[str]]:
    """``docs`` with _n (tokens) and _p (posteriors), and the domains in the
    order of _p.  ``labels`` has the id column and ``domain``; an id with
    several domains counts with the first in text order, nulls are left out."""
    known = labels.select(F.col(id_col).alias("_label_id"), F.col("domain").cast("string").alias("domain")).filter(
        "_label_id is not null and domain is not null").groupBy("_label_id").agg(F.min("domain").alias("domain"))
    texts = docs.select(F.col(id_col).alias("_label_id"), F.col(text_col).alias("_text"))
    # Labels grow with the documents: the same kind of join at every size.
    labelled = _described(texts.join(known.hint("merge"), "_label_id"), F.col("_text")).select("domain", "_seen")
    domains, base, weights = _fit(labelled, tokens)
    described = _described(docs, F.col(text_col))
    if not weights:
        return described.withColumn("_p", F.array(*[F.lit(1.0 / len(domains))] * len(domains))).drop("_seen"), domains
    vocabulary = F.array(*[F.lit(t) for t in weights])
    hits = F.transform(F.array_intersect("_seen", vocabulary), lambda t: F.array_position(vocabulary, t).cast("int"))
    described = described.withColumn("_hits", hits).drop("_seen")
    by_domain = [F.array(*[F.lit(w[k]) for w in weights.values()]) for k in range(len(base))]

    def total(b: float, weight: Column) -> Column:
        return F.aggregate("_hits", F.lit(b), lambda acc, i: acc + F.element_at(weight, i))

    score = F.array(*map(total, base, by_domain))
    scored = described.withColumn("_s", score).withColumn("_top", F.array_max("_s")).withColumn(
        "_odds", F.transform("_s", lambda s: F.exp(s - F.col("_top")))).withColumn(
        "_sum", F.aggregate("_odds", F.lit(0.0), lambda acc, x: acc + x))
    return scored.withColumn("_p", F.transform("_odds", lambda x: x / F.col("_sum"))).drop(
        "_hits", "_s", "_top", "_odds", "_sum"), domains


def _state(steps: list[tuple[list[float], float]], k: int) -> Column:
    """struct<r, z>: rate and extrapolated rate after the steps so far, each a
    step per domain and a momentum."""
    start = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("z"))
    if not steps:
        return start
    taken = F.array(*[F.struct(F.array(*[F.lit(float(x)) for x in g]).alias("g"), F.lit(float(m)).alias("m")) for g, m in steps])
    moves = F.transform(taken, lambda h: F.struct(
        reduce(Column.__add__, [F.get(F.col("_p"), i) * F.get(h["g"], i) for i in range(k)]).alias("d"), h["m"].alias("m")))

    def follow(acc: Column, h: Column) -> Column:
        rate = F.greatest(F.lit(0.0), acc["z"] - h["d"])
        return F.struct(rate.alias("r"), (rate + h["m"] * (rate - acc["r"])).alias("z"))

    return F.aggregate(moves, start, follow)


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
        total: float | None = None, iterations: int = ITERATIONS, tolerance: float = TOLERANCE) -> tuple[DataFrame, list[str], float]:
    """``docs`` with _n, _p and _rate, the domains, and the residual: the
    largest miss of a domain's expected tokens at these rates, as a share of
    the total.  It is above ``tolerance`` where the iterations ended first, or
    where no rates meet the targets (a warning says so).

    ``targets`` are shares of ``total`` expected tokens (as many as at rate 1,
    if not given), scaled to sum to 1 over the domains that have tokens;
    domains without a target get none.  Without any target in the table, and
    without labels, every rate is 1.
    """
    described, domains = domain_posteriors(docs, labels, id_col, text_col)
    described = materialise(described, "posteriors")
    k = len(domains)

    def sums(field: str, steps: list) -> list[float]:
        at = described.select("_n", "_p", _state(steps, k)[field].alias("_w"))
        row = at.agg(*[F.sum(F.col("_n") * F.get("_p", i) * F.col("_w")) for i in range(k)]).first()
        return [float(x or 0.0) for x in row]

    at_one = sums("r", [])
    share = [targets.get(d, 0.0) if a > 0 else 0.0 for d, a in zip(domains, at_one, strict=True)]
    steps: list[tuple[list[float], float]] = []
    residual = 0.0
    if sum(share) > 0:
        whole = total if total is not None else sum(at_one)
        wanted = [whole * s / sum(share) for s in share]
        now, t = at_one, 1.0
        for _ in range(iterations):
            if max(abs(s - w) for s, w in zip(now, wanted, strict=True)) <= tolerance * whole:
                break
            after = (1 + sqrt(1 + 4 * t * t)) / 2
            steps.append(([(s - w) / a if a > 0 else 0.0 for s, w, a in zip(now, wanted, at_one, strict=True)], (t - 1) / after))
            now, t = sums("z", steps), after
        reached = sums("r", steps) if steps else at_one
        residual = max(abs(s - w) for s, w in zip(reached, wanted, strict=True)) / whole
        if residual > tolerance:
            warnings.warn(f"the expected domain totals miss their targets by up to {residual:.2%} of the total", stacklevel=2)
    return described.withColumn("_rate", _state(steps, k)["r"]), domains, residual


def quality_domains(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The domains of the production mix, from the quality and toxic labels."""
    return labels.select(id_col, F.concat(F.lit("quality"), F.col("quality").cast("string"), F.lit("_toxic"),
                                          F.col("toxic").cast("string")).alias("domain"))


def document_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, id_col: str = "doc_id",
                   text_col: str = "text", **options) -> DataFrame:
    """One row per input row: doc_id, n_tokens, rate, domain (of the largest
    posterior), p_<domain> for every domain of the labels, and residual (the
    same in every row): the largest miss of a domain's total, as a share of all.

    Null and empty texts have no tokens and the rate of their posteriors; null
    ids have no label; repeated rows each have their row and count as often;
    an empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), "domain")
    mixed, domains, residual = mix(rows, known, targets, "doc_id", "text", **options)
    names = F.array(*[F.lit(d) for d in domains])
    return mixed.select("doc_id", F.col("_n").alias("n_tokens"), F.col("_rate").alias("rate"),
                        F.get(names, F.array_position("_p", F.array_max("_p")).cast("int") - 1).alias("domain"),
                        *[F.get("_p", i).alias(f"p_{d}") for i, d in enumerate(domains)], F.lit(residual).alias("residual"))


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, id_col: str = "doc_id",
                    text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every row repeated by its rate: the whole part, and once
    more with the probability of the rest, by a hash of the id and the text.

    A rate above 1 writes a document more than once, also one that a stage
    before has made unique: a domain that is to have more tokens than it has
    needs that.  A row is repeated floor(rate) + 1 times at most.  Null ids and
    texts are rows like any other; repeated rows are each repeated alike; an
    empty table gives an empty one; without labels every row stays once."""
    whole = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    known = labels.select(F.col(id_col).alias("_id"), "domain")
    mixed, _, _ = mix(whole, known, targets, "_id", "_text", **options)
    chance = F.pmod(F.xxhash64("_id", "_text"), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(F.col("_rate") + chance).cast("int")
    return mixed.select("_row", F.explode(F.array_repeat(F.lit(0), copies))).select("_row.*")
