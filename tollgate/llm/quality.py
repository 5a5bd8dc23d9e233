"""Text quality by a linear model on naive Bayes scaled n-gram indicators.

Features are indicators of hashed n-grams: words (orders 1 and 2) and word
forms (orders 1 to 3).  A form is the word's sequence of character classes
with runs collapsed (``Word,`` and ``The.`` share one, ``THE!!`` and ``re***``
do not) and whether the word repeats the one before.

Each indicator is scaled by the log-count ratio of the two classes.  The
ratios come from all labelled training rows.  A linear hinge-loss model is
then fitted to the scaled, length-normalised vectors by dual coordinate
descent, on a bounded sample: at most SAMPLE / 2 distinct texts of each class,
by a hash of the text, each with its number of rows as weight.  So a text that
a third of the rows repeat is one row of the sample.  The model's margins become
probabilities through a logistic fit to cross-fitted margins, weighted to the
classes' share in all training rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.language_id import held_out
from tollgate.llm.staging import materialise
from tollgate.llm.textarrays import Block, blocks, distinct_by_text, mix, span_hashes, words

DIM = 1 << 18
SAMPLE = 8_000
SMOOTHING = 1.0
C, EPOCHS, FOLDS = 1.0, 12, 4
THRESHOLD = 0.3

_FORM = np.full(256, 4, np.uint8)  # 4: bytes of other scripts, like small letters
_FORM[:128] = 5
_FORM[[*range(0x61, 0x7B)]] = 4
_FORM[[*range(0x41, 0x5B)]] = 3
_FORM[[*range(0x30, 0x3A)]] = 2
for _b in range(0x21, 0x7F):
    if not chr(_b).isalnum():
        _FORM[_b] = _b + 64
_ORDER = mix(np.arange(1, 9, dtype=np.uint64))


def features(block: Block, dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text, and their offsets."""
    w = words(block)
    forms = _FORM[block.data]
    keep = np.ones(len(forms), bool)
    keep[1:] = forms[1:] != forms[:-1]
    keep[w.start] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    form = span_hashes(forms[keep], place[w.start], place[w.end])
    count = w.counts
    text = np.repeat(np.arange(block.n), count)
    repeats = np.zeros(len(form), bool)
    repeats[1:] = (w.hash[1:] == w.hash[:-1]) & (text[1:] == text[:-1])
    form = mix(form + repeats.astype(np.uint64))
    found, owner = [], []
    for kind, values, orders in ((0, w.hash, 2), (2, form, 3)):
        h = np.zeros(len(values), np.uint64)
        for order in range(1, orders + 1):
            n = len(values) - order + 1
            if n <= 0:
                break
            h = mix(h[:n] * np.uint64(0x9E3779B97F4A7C15) + values[order - 1:])
            whole = text[:n] == text[order - 1:]
            found.append((mix(h ^ _ORDER[kind + order]) % np.uint64(dim))[whole])
            owner.append(text[:n][whole])
    if not found:
        return np.zeros(0, np.int64), np.zeros(block.n + 1, np.int64)
    found, owner = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=block.n))])
    values, offsets = distinct_by_text(found[order].astype(np.int64), offsets)
    return values, offsets


@dataclass
class QualityModel:
    weight: np.ndarray  # by feature; margin = sum / norm + bias
    square: np.ndarray  # by feature: squared scale, for the norm
    bias: float
    slope: float
    shift: float

    def scores(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        text = np.repeat(np.arange(n), np.diff(offsets))
        total = np.bincount(text, weights=self.weight[values], minlength=n)
        norm = np.sqrt(np.bincount(text, weights=self.square[values], minlength=n))
        margin = total / np.maximum(norm, 1e-9) + self.bias
        return 1 / (1 + np.exp(-(self.slope * margin + self.shift)))


def fit_hinge(rows: list[np.ndarray], data: list[np.ndarray], y: np.ndarray, cost: np.ndarray, dim: int,
              epochs: int = EPOCHS, seed: int = 1) -> tuple[np.ndarray, float]:
    """min |w|^2 / 2 + sum cost_i max(0, 1 - y_i (w x_i + b)) over its dual, one
    coordinate at a time; the bias is a constant feature."""
    w, b = np.zeros(dim), 0.0
    alpha = np.zeros(len(rows))
    diagonal = np.array([float(d @ d) + 1 for d in data])
    order, random = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        random.shuffle(order)
        worst = 0.0
        for i in order.tolist():
            index, x = rows[i], data[i]
            gradient = y[i] * (w[index] @ x + b) - 1
            a = alpha[i]
            step = gradient if 0 < a < cost[i] else (min(gradient, 0) if a == 0 else max(gradient, 0))
            if step:
                worst = max(worst, abs(step))
                alpha[i] = min(max(a - gradient / diagonal[i], 0.0), cost[i])
                w[index] += (alpha[i] - a) * y[i] * x
                b += (alpha[i] - a) * y[i]
        if worst < 0.01:
            break
    return w, b


def _logistic(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted one-variable logistic regression by Newton steps."""
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - label)) + 1e-3 * np.array([beta[0] - 1, 0])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


_DESCRIBED = "label long, feature long, n0 long, n1 long, content long, row array<int>"


def _describe(dim: int, shares: tuple[float, float]):
    """Class counts of the task's rows by feature, and the sampled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, dim), np.int64)
        n = np.zeros(2, np.int64)
        names = ["label", "feature", "n0", "n1", "content", "row"]
        for batch in batches:
            labels, content = batch.column("label").to_numpy(), batch.column("content").to_numpy()
            # By content, so that the sample does not depend on the partitions.
            place = mix(content.view(np.uint64)) / 2.0 ** 64
            chosen = place < np.where(labels == 1, shares[1], shares[0])
            for block in blocks(batch.column("body")):
                values, offsets = features(block, dim)
                to = slice(block.first, block.first + block.n)
                per = np.diff(offsets)
                for y in (0, 1):
                    counts[y] += np.bincount(values[np.repeat(labels[to] == y, per)], minlength=dim)
                    n[y] += int((labels[to] == y).sum())
                some = np.flatnonzero(chosen[to])
                if len(some):
                    none = pa.nulls(len(some), pa.int64())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(labels[to][some]), none, none, none, pa.array(content[to][some]),
                        pa.array([values[offsets[i]:offsets[i + 1]].astype(np.int32) for i in some.tolist()], pa.list_(pa.int32()))],
                        names=names)
        some = np.append(np.flatnonzero(counts.sum(axis=0)), dim)  # feature dim: the number of rows
        both = np.concatenate([counts, n[:, None]], axis=1)[:, some]
        none = pa.nulls(len(some), pa.int64())
        yield pa.RecordBatch.from_arrays([
            none, pa.array(some.astype(np.int64)), pa.array(both[0]), pa.array(both[1]), none,
            pa.nulls(len(some), pa.list_(pa.int32()))], names=names)

    return run


def fit_quality(training: DataFrame, text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE,
                dim: int = DIM) -> QualityModel:
    """From rows with a 0/1 label; other labels are left out.  With rows of one
    class only, or none, every text gets that class's share (0.5 without rows)."""
    rows = training.select(F.col(label_col).cast("int").alias("label"), F.coalesce(F.col(text_col), F.lit("")).alias("body")
                           ).filter("label in (0, 1)").withColumn("content", F.xxhash64("body"))
    size = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(size.values())
    if len(size) < 2:
        share = min(max(size.get(1, 0) / total if total else 0.5, 1e-3), 1 - 1e-3)
        return QualityModel(np.zeros(dim, np.float32), np.ones(dim, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    shares = tuple(min(1.0, sample / 2 / size[y]) for y in (0, 1))
    described = materialise(rows.select(F.col("label").cast("long").alias("label"), "content", "body").mapInArrow(
        _describe(dim, shares), _DESCRIBED), "quality")
    table = described.filter("feature is not null").groupBy("feature").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()  # one row per feature at most
    counts = np.zeros((2, dim + 1))
    for y in (0, 1):
        counts[y, table.column("feature").to_numpy()] = table.column(f"n{y}").to_numpy()
    smooth = counts[:, :dim] + SMOOTHING
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())

    # Distinct texts with their rows; at most sample / 2 of a class reach the driver.
    texts = described.filter("row is not null").groupBy("label", "content").agg(
        F.count(F.lit(1)).alias("n"), F.first("row").alias("row"))
    drawn = pa.concat_tables([texts.filter(F.col("label") == v).orderBy("content").limit(max(sample // 2, 1)).toArrow() for v in (0, 1)])
    label, copies = drawn.column("label").to_numpy(), drawn.column("n").to_numpy()
    index = [np.asarray(r.values.to_numpy(), np.int64) for r in drawn.column("row")]
    # A defined order, whatever order the tasks wrote in.
    order = np.lexsort((label, drawn.column("content").to_numpy()))
    label, copies, index = label[order], copies[order], [index[i] for i in order.tolist()]
    data = []
    for i in index:
        x = ratio[i]
        data.append(x / max(float(np.sqrt(x @ x)), 1e-9))
    y = np.where(label == 1, 1.0, -1.0)
    cost = C * copies.astype(float)
    fold = np.arange(len(y)) % FOLDS
    margin = np.zeros(len(y))

    def fitted(chosen: np.ndarray) -> tuple[np.ndarray, float]:
        return fit_hinge([index[i] for i in chosen], [data[i] for i in chosen], y[chosen], cost[chosen], dim)

    for f in range(FOLDS):
        w, b = fitted(np.flatnonzero(fold != f))
        for i in np.flatnonzero(fold == f):
            margin[i] = w[index[i]] @ data[i] + b
    drawn_n = np.bincount(label, weights=copies, minlength=2)
    weight = np.array([size[v] / max(drawn_n[v], 1) for v in (0, 1)])[label] * copies / total * len(label) / copies.mean()
    slope, shift = _logistic(margin, label.astype(float), weight)
    w, b = fitted(np.arange(len(y)))
    return QualityModel((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), b, slope, shift)


def _score(model, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            others = [c for c in batch.schema.names if c != "body"]
            for block in blocks(batch.column("body")):
                score = m.scores(*features(block, dim))
                to = slice(block.first, block.first + block.n)
                yield pa.RecordBatch.from_arrays([batch.column(c)[to] for c in others] + [pa.array(score)],
                                                 names=others + ["score"])

    return run


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and score, the probability of label 1; a text without
    words has the score of the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(_score(shared, len(model.weight)), f"{types}, score double")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted.

    Labels are learned from rows outside the held-out fold.  Null ids have no
    label and are not held out; an id with several labels has the largest;
    null and empty texts are scored like any other; an empty table of
    documents gives an empty result.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       held_out(id_col).alias("held_out"))
    label = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        "label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    # Labels grow with the documents: the same kind of join at every size.
    training = rows.filter("not held_out").join(label.hint("merge"), "doc_id")
    model = fit_quality(training, "text", "label")
    return score_quality(rows, model, keep=("doc_id", "held_out")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
