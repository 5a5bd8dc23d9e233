"""Toxicity by a factorization machine over hashed terms.

A text's features are its distinct terms, hashed.  The score is a bias, a
weight for every term and, for every pair of terms, the product of their
factor vectors, so a pair (an insult with a mention of a group) can count
although neither of its terms does.  With factors the sum over all pairs is
linear in the number of terms.

The machine is fitted on a bounded sample: at most SAMPLE / 2 distinct texts
of each class, the first ones by a hash of the text, weighted by their copies
and by the class's share of all labelled rows.  So one text that a third of
the rows repeat is one row of the sample, and the sample is the same however
the rows are partitioned.  Documents are joined to labels by id and hash only;
texts are not shuffled.  Terms that fewer than LEAST sampled texts hold get no
weight.  A term's value is the strength of its association with the label, and
a small floor: without it the many common terms of a long text drown the few
that tell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.language_id import held_out
from tollgate.llm.textarrays import NON_ALNUM, Block, blocks, mix, span_sums, words

DIM = 1 << 18  # half of it for terms, half for repeated ones
STEMS = (4, 5, 6, 7)  # letters
SAMPLE = 10_000
FACTORS = 6
LEAST = 8  # sampled texts that hold a term
EPOCHS, BATCH = 8, 64
RATE, SPARSE, SHRINK = 0.2, 1e-4, 1e-2
FLOOR, CERTAIN = 0.1, 10.0
THRESHOLD = 0.5


def terms(block: Block, dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each text, and their offsets.  Terms are words
    (A-Z lower-cased), word beginnings of STEMS letters, which stand for
    inflected and compounded forms, and both once more where a text has them
    more than once."""
    w = words(block, NON_ALNUM)
    text = np.repeat(np.arange(block.n), w.counts)
    sums = span_sums(block.data, w.start, lower=True)
    letters = np.flatnonzero((block.data & 0xC0) != 0x80)
    rank = np.searchsorted(letters, w.start)
    letters = np.append(letters, np.full(max(STEMS) + 1, len(block.data)))
    found, owner = [w.hash], [text]
    for k in STEMS:
        cut = letters[rank + k]
        longer = np.flatnonzero(cut < w.end)  # a whole word is a term already
        found.append(mix(sums[cut[longer]] - sums[w.start[longer]] + np.uint64(k)))
        owner.append(text[longer])
    found, owner = np.concatenate(found), np.concatenate(owner)
    feature = (found % np.uint64(dim // 2)).astype(np.int64)
    key, times = np.unique(owner * (dim // 2) + feature, return_counts=True)
    owner, feature = key // (dim // 2), key % (dim // 2)
    again = times > 1
    owner, feature = np.concatenate([owner, owner[again]]), np.concatenate([feature, feature[again] + dim // 2])
    order = np.argsort(owner, kind="stable")
    return feature[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=block.n))])


@dataclass
class FactorizationMachine:
    bias: float
    weight: np.ndarray  # by feature, times its scale
    factor: np.ndarray  # by feature and factor, times the scale

    def margins(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """bias + sum of weights + sum over pairs of products of factors."""
        n = len(offsets) - 1
        text = np.repeat(np.arange(n), np.diff(offsets))
        out = self.bias + np.bincount(text, weights=self.weight[values], minlength=n)
        for f in range(self.factor.shape[1]):
            v = self.factor[values, f]
            total = np.bincount(text, weights=v, minlength=n)
            out += 0.5 * (total * total - np.bincount(text, weights=v * v, minlength=n))
        return out

    def scores(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(values, offsets), -40, 40)))


def term_scales(rows: list[np.ndarray], label: np.ndarray, dim: int, floor: float = FLOOR) -> np.ndarray:
    """Value of each feature: the strength of its association with the label,
    in standard errors, as a share of CERTAIN; ``floor`` at least, so that a
    pair whose terms show nothing alone still counts, and 1 at most."""
    held = [np.bincount(np.concatenate([np.zeros(0, np.int64), *[r for r, l in zip(rows, label, strict=True) if l == y]]),
                        minlength=dim) for y in (0, 1)]
    n = [float((label == y).sum()) for y in (0, 1)]
    share = (held[0] + held[1] + 1) / (n[0] + n[1] + 2)
    error = np.sqrt(share * (1 - share) * (1 / max(n[0], 1) + 1 / max(n[1], 1)))
    return np.clip(np.abs(held[1] / max(n[1], 1) - held[0] / max(n[0], 1)) / error / CERTAIN, floor, 1)


def fit_machine(rows: list[np.ndarray], label: np.ndarray, cost: np.ndarray, dim: int, factors: int = FACTORS,
                epochs: int = EPOCHS, seed: int = 1, least: int = LEAST, sparse: float = SPARSE,
                shrink: float = SHRINK, rate: float = RATE, floor: float = FLOOR) -> FactorizationMachine:
    """Weighted logistic loss by adaptive steps over batches of rows of
    distinct features."""
    scale = term_scales(rows, label, dim, floor)
    held = np.bincount(np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64), minlength=dim)
    used = np.flatnonzero(held >= least)
    place = np.full(dim, -1, np.int64)
    place[used] = np.arange(len(used))
    kept = [p[p >= 0] for p in (place[r] for r in rows)]
    x = scale[used]
    random = np.random.default_rng(seed)
    share = float((cost * label).sum() / cost.sum())
    bias, w = float(np.log(share / (1 - share))), np.zeros(len(used))
    v = random.normal(0, 0.05, (len(used), factors))
    gw, gv, gb = np.full(len(used), 1e-6), np.full((len(used), factors), 1e-6), 1e-6
    cost = cost / cost.mean()
    order = np.arange(len(rows))
    for _ in range(epochs):
        random.shuffle(order)
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            n = len(chosen)
            index = np.concatenate([kept[i] for i in chosen])
            text = np.repeat(np.arange(n), [len(kept[i]) for i in chosen])
            value = x[index]
            own = v[index] * value[:, None]
            total = np.zeros((n, factors))
            for f in range(factors):
                total[:, f] = np.bincount(text, weights=own[:, f], minlength=n)
            square = np.bincount(text, weights=(own * own).sum(axis=1), minlength=n)
            margin = bias + np.bincount(text, weights=w[index] * value, minlength=n) + 0.5 * ((total * total).sum(axis=1) - square)
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[chosen]) * cost[chosen] / n
            step = float(slope.sum())
            gb += step * step
            bias -= rate * step / np.sqrt(gb)
            touched, back = np.unique(index, return_inverse=True)
            pull = slope[text] * value
            by = np.bincount(back, weights=pull, minlength=len(touched))
            gw[touched] += by * by
            speed = rate / np.sqrt(gw[touched])
            moved = w[touched] - speed * by
            w[touched] = np.sign(moved) * np.maximum(np.abs(moved) - speed * sparse, 0)
            for f in range(factors):
                by = np.bincount(back, weights=pull * (total[text, f] - own[:, f]), minlength=len(touched)) + shrink * v[touched, f]
                gv[touched, f] += by * by
                v[touched, f] -= rate * by / np.sqrt(gv[touched, f])
    weight, factor = np.zeros(dim, np.float32), np.zeros((dim, factors), np.float32)
    weight[used], factor[used] = w * x, v * x[:, None]
    return FactorizationMachine(float(bias), weight, factor)


def _features(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("body")):
                values, offsets = terms(block, dim)
                yield pa.RecordBatch.from_arrays([
                    batch.column("content")[block.first:block.first + block.n],
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))],
                    names=["content", "row"])

    return run


def fit_toxicity(texts: DataFrame, labels: DataFrame, sample: int = SAMPLE, dim: int = DIM) -> FactorizationMachine:
    """From ``texts`` (doc_id, body) and ``labels`` (doc_id, label 0 or 1).
    With one class only, or none, every text gets that class's share (0.5
    without rows).  A text with both labels counts for both by its rows."""
    # Ids and hashes alone are shuffled; the same kind of join at every size.
    marked = texts.select("doc_id", F.xxhash64("body").alias("content")).join(labels.hint("merge"), "doc_id")
    by_text = marked.groupBy("content").agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1"))
    by_text = by_text.withColumn("label", (F.col("n1") > F.col("n0")).cast("int"))
    size = by_text.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    n0, n1 = size["n0"] or 0, size["n1"] or 0
    if not n0 or not n1:
        share = min(max(n1 / (n0 + n1) if n0 + n1 else 0.5, 1e-3), 1 - 1e-3)
        return FactorizationMachine(float(np.log(share / (1 - share))), np.zeros(dim, np.float32), np.zeros((dim, 1), np.float32))
    drawn = {}
    for y in (0, 1):
        first = by_text.filter(F.col("label") == y).orderBy(F.xxhash64("content"), "content").limit(sample // 2)
        drawn |= {r["content"]: (r["n0"], r["n1"]) for r in first.collect()}  # at most sample / 2 rows of three numbers
    spark = texts.sparkSession
    wanted = spark.createDataFrame([(c,) for c in drawn], "content long")
    held = texts.select(F.xxhash64("body").alias("content"), "body").join(F.broadcast(wanted), "content", "left_semi")
    # Copies are removed before their features are sent.
    found = held.mapInArrow(_features(dim), "content long, row array<int>").dropDuplicates(["content"]).toArrow()
    rows, label, cost = [], [], []
    order = np.argsort(found.column("content").to_numpy(), kind="stable")
    content, lists = found.column("content").to_pylist(), found.column("row").combine_chunks()
    for i in order.tolist():
        for y in (0, 1):
            if n := drawn[content[i]][y]:
                rows.append(lists[i].values.to_numpy().astype(np.int64))
                label.append(y)
                cost.append(n)
    label, cost = np.array(label, float), np.minimum(np.array(cost, float), np.median(cost) * 10)
    for y, n in ((0, n0), (1, n1)):  # the classes' shares of all labelled rows
        cost[label == y] *= n / (n0 + n1) / cost[label == y].sum()
    return fit_machine(rows, label, cost, dim)


def _score(model, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            others = [c for c in batch.schema.names if c != "body"]
            for block in blocks(batch.column("body")):
                score = m.scores(*terms(block, dim))
                to = slice(block.first, block.first + block.n)
                yield pa.RecordBatch.from_arrays([batch.column(c)[to] for c in others] + [pa.array(score)],
                                                 names=others + ["score"])

    return run


def score_toxicity(docs: DataFrame, model: FactorizationMachine, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``docs`` (with ``body``) and score, the probability
    of label 1; a text without terms has the score of the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(*[F.col(c) for c in keep], "body")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(_score(shared, len(model.weight)), f"{types}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted.

    Labels are learned from rows outside the held-out fold.  Null ids have no
    label and are not held out; an id with several labels has the largest;
    null and empty texts are scored like any other; an empty table of
    documents gives an empty result.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"),
                       held_out(id_col).alias("held_out"))
    label = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        "label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    model = fit_toxicity(rows.filter("not held_out"), label, sample)
    return score_toxicity(rows, model, ("doc_id", "held_out")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
