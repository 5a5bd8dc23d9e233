"""Language identification with interpolated Kneser-Ney character models.

Every language has a character 4-gram model over words padded with word
boundaries.  A letter beyond U+FFFF is two characters, its surrogates.  Counts
come from all training rows: each task counts its distinct
words once, turns them into weighted 4-grams and sends one row per (language,
4-gram); Spark sums them.  A 4-gram of 16-bit characters is exactly one 64-bit
key, so a model is a set of sorted key arrays with binary search: probability
by n-gram and back-off weight by context, for the orders 4 to 1.  Lower orders
use continuation counts, and each order has its own absolute discount.

A text's language is that of the lowest cross-entropy per character.  A text
is rejected when its cross-entropy lies far beyond what training rows of that
language and of like length show: a high quantile and a multiple of the middle
half's width, calibrated on all of them, so single odd rows do not set it.

No 4-gram is cut: a cut would take small languages first and change the counts
of counts.  Up to MODEL_GRAMS rows (language, 4-gram) the models are sent to
every task.  Beyond it they stay tables: the same estimates by grouping and
joining, the cost of each distinct 4-gram of the corpus by one join of its
back-off chain, of each distinct word from its 4-grams, and a text's from its
words.  Both forms give the same results but for the order of sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.staging import materialise
from tollgate.llm.textarrays import Block, Words, blocks, words

ORDER = 4
UNKNOWN = "und"
#: Accepted is up to this quantile, plus so many widths of the middle half, plus nats.
REJECT_QUANTILE, REJECT_WIDTHS, REJECT_MARGIN = 0.99, 3.0, 0.25
_BIN_ROWS = 30  # of a length (power of two of events) that has bounds of its own
_EVIDENCE = 60.0  # characters after which the score's confidence no longer grows
_FLUSH = 1 << 21  # distinct n-grams that a counting task holds
MODEL_GRAMS = 6_000_000  # rows that the driver collects and every task gets
SALTS = 32  # parts of a word that very many texts hold

#: ASCII bytes that are no letters separate words.
_NO_LETTER = bytes(b for b in range(128) if not chr(b).isalpha())
_letter = np.zeros(0x110000, np.int8)  # 0 not looked at yet, 1 letter, 2 other


def _is_letter(points: np.ndarray) -> np.ndarray:
    for c in np.unique(points[_letter[points] == 0]).tolist():
        _letter[c] = 1 if chr(c).isalpha() else 2
    return _letter[points] == 1


def word_grams(block: Block, w: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """4-gram keys of the chosen words and the word that each belongs to.

    Every letter and the boundary after it is one event, with the three
    characters before it; characters that are no letters are boundaries too.
    """
    start, end = w.start[which], w.end[which]
    size = end - start + 1
    begin = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(begin, size) + np.repeat(start, size)
    joined = np.append(block.data, np.uint8(0x20))[np.minimum(at, len(block.data))]
    joined[begin + size - 1] = 0x20
    text = joined.tobytes().decode("utf-8", "replace").lower()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    breaks = points == 0x20
    word = np.cumsum(breaks) - breaks
    letter = _is_letter(points)
    points = np.where(letter, points, 0).astype(np.uint64)  # 0 is the boundary
    wide = points > 0xFFFF
    if wide.any():  # such a letter is two symbols, its surrogates
        units = 1 + wide
        second = np.cumsum(units)[wide] - 1
        word, letter, points = (np.repeat(x, units) for x in (word, letter, points))
        rest = points[second] - np.uint64(0x10000)
        points[second - 1], points[second] = np.uint64(0xD800) + (rest >> np.uint64(10)), np.uint64(0xDC00) + (rest & np.uint64(0x3FF))
    before = np.concatenate([[False], letter[:-1]])
    event = letter | before  # a boundary counts only right after a letter
    key = points.copy()
    inside = np.ones(len(points), bool)
    for back in range(1, ORDER):
        # A context goes back to the nearest boundary and is padded from there.
        inside &= np.concatenate([np.zeros(min(back, len(points)), bool), letter[:-back] if back < len(points) else letter[:0]])
        shifted = np.concatenate([np.zeros(min(back, len(points)), np.uint64), points[:-back] if back < len(points) else points[:0]])
        key |= np.where(inside, shifted, np.uint64(0)) << np.uint64(16 * back)
    return key[event], word[event]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, gram, n): weighted 4-grams of the task's distinct words."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merge() -> int:
        for lang, parts in held.items():
            held[lang] = [_summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
        return sum(len(parts[0][0]) for parts in held.values())

    def flush() -> Iterator[pa.RecordBatch]:
        merge()
        for lang, [(keys, n)] in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)],
                                             names=["lang", "gram", "n"])
        held.clear()

    waiting = 0

    for batch in batches:
        langs = batch.column("lang").to_numpy(zero_copy_only=False)
        for block in blocks(batch.column("body")):
            w = words(block, _NO_LETTER)
            names, code = np.unique(langs[block.first:block.first + block.n].astype(str), return_inverse=True)
            of_word = np.repeat(code, w.counts)
            for i, lang in enumerate(names.tolist()):
                mine = np.flatnonzero(of_word == i)
                if not len(mine):
                    continue
                _, first, times = np.unique(w.hash[mine], return_index=True, return_counts=True)
                key, word = word_grams(block, w, mine[first])
                if not len(key):
                    continue
                held.setdefault(lang, []).append(_summed(key, times[word].astype(np.int64)))
                waiting += len(held[lang][-1][0])
            if waiting > _FLUSH:
                waiting = merge()
                if waiting > _FLUSH // 2:
                    yield from flush()
                    waiting = 0
    yield from flush()


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


@dataclass
class KneserNey:
    """One language's model: per order, n-gram -> log probability and
    context -> log back-off weight in sorted arrays."""

    grams: list[np.ndarray]  # order 1 first
    logp: list[np.ndarray]
    contexts: list[np.ndarray]  # of the order above
    backoff: list[np.ndarray]
    unseen: float

    @classmethod
    def fit(cls, grams: np.ndarray, counts: np.ndarray, vocabulary: int) -> KneserNey:
        """From sorted distinct 4-gram keys and their counts."""
        levels = [(grams, counts.astype(float))]
        for order in range(ORDER - 1, 0, -1):
            # Continuation counts: how many different characters come before.
            kept = levels[0][0] & np.uint64((1 << (16 * order)) - 1)
            keys, n = _summed(kept, np.ones(len(kept), np.int64))
            levels.insert(0, (keys, n.astype(float)))
        unseen = 1.0 / vocabulary
        out = cls([], [], [], [], 0.0)
        for order, (keys, n) in enumerate(levels, 1):
            n1, n2 = float((n == 1).sum()), float((n == 2).sum())
            discount = min(0.99, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.05
            context = keys >> np.uint64(16)
            first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            size = np.diff(np.append(first, len(keys)))
            total = np.add.reduceat(n, first)
            weight = discount * size / total
            if order == 1:
                lower = np.full(len(keys), unseen)
            else:
                lower = np.exp(out.score(keys & np.uint64((1 << (16 * (order - 1))) - 1), order - 1))
            p = np.maximum(n - discount, 0) / np.repeat(total, size) + np.repeat(weight, size) * lower
            if order == 1:
                out.unseen = float(np.log(weight[0] * unseen))
            out.grams.append(keys)
            out.logp.append(np.log(p))
            out.contexts.append(context[first])
            out.backoff.append(np.log(weight))
        return out

    def score(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of each key's last character after the others."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        for level in range(order, 0, -1):
            part = keys[left] & np.uint64((1 << (16 * level)) - 1) if level < 4 else keys[left]
            at, found = _find(self.grams[level - 1], part)
            out[left[found]] += self.logp[level - 1][at[found]]
            left, part = left[~found], part[~found]
            if level == 1:
                out[left] += self.unseen
            else:
                at, known = _find(self.contexts[level - 1], part >> np.uint64(16))
                out[left[known]] += self.backoff[level - 1][at[known]]
        return out


def _find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return at, keys[at] == x


@dataclass
class Accepted:
    """Largest accepted cross-entropy of a language by the number of events n:
    mean + excess / sqrt(n) + margin, with an excess for each power of two."""

    mean: float
    excess: float  # of lengths with few rows
    by_length: dict[int, float]
    margin: float

    def limit(self, n: np.ndarray) -> np.ndarray:
        length = np.floor(np.log2(np.maximum(n, 1))).astype(int)
        kinds, of = np.unique(length, return_inverse=True)
        excess = np.array([self.by_length.get(k, self.excess) for k in kinds.tolist()])
        return self.mean + excess[of] / np.sqrt(np.maximum(n, 1)) + self.margin


@dataclass
class LanguageModel:
    languages: list[str]
    models: list[KneserNey]
    #: without a language here, all its texts are accepted
    accepted: dict[str, Accepted] | None = None


class Scorer:
    """Costs of texts; remembers words by hash up to a bound."""

    SLOTS = 1 << 18

    def __init__(self, model: LanguageModel):
        self.model = model
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.cost = np.zeros((self.SLOTS, len(model.languages) + 1), np.float32)

    def texts(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Per text: total cost (nats) by language, and number of events."""
        n_lang = len(self.model.languages)
        w = words(block, _NO_LETTER)
        slot = (w.hash >> np.uint64(46)).astype(np.int64)
        cost = self.cost[slot]
        missing = np.flatnonzero(self.keys[slot] != w.hash)
        if len(missing):
            _, first, back = np.unique(w.hash[missing], return_index=True, return_inverse=True)
            new = missing[first]
            key, word = word_grams(block, w, new)
            distinct, of = np.unique(key, return_inverse=True)
            fresh = np.zeros((len(new), n_lang + 1))
            for i, m in enumerate(self.model.models):
                fresh[:, i] = np.bincount(word, weights=-m.score(distinct)[of], minlength=len(new))
            fresh[:, n_lang] = np.bincount(word, minlength=len(new))
            cost[missing] = fresh[back]
            self.keys[slot[new]], self.cost[slot[new]] = w.hash[new], fresh
        text = np.repeat(np.arange(block.n), w.counts)
        out = np.stack([np.bincount(text, weights=cost[:, i], minlength=block.n) for i in range(n_lang + 1)], axis=1)
        return out[:, :n_lang], out[:, n_lang]


def _decide(cost: np.ndarray, n: np.ndarray, languages: list[str], accepted: dict[str, Accepted] | None) -> list[pa.Array]:
    """The predicted columns of texts with these costs by language and events."""
    names = np.array([*languages, UNKNOWN], object)
    entropy = cost / np.maximum(n, 1)[:, None]
    best = entropy.argmin(axis=1) if len(languages) else np.zeros(len(n), np.int64)
    least = entropy[np.arange(len(n)), best] if len(languages) else np.zeros(len(n))
    apart = np.minimum(entropy - least[:, None], 50) * np.minimum(n, _EVIDENCE)[:, None]
    score = 1 / np.maximum(np.exp(-apart).sum(axis=1), 1) if len(languages) else np.zeros(len(n))
    none = (n == 0) | (len(languages) == 0)
    best, score = np.where(none, len(languages), best), np.where(none, 0.0, score)
    rejected = none.copy()
    if accepted is not None:
        for i, lang in enumerate(languages):
            if lang in accepted:
                mine = np.flatnonzero(best == i)
                rejected[mine] |= least[mine] > accepted[lang].limit(n[mine])
    return [pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(least), pa.array(n.astype(np.int64)),
            pa.array(rejected)]


_DECIDED = ["lang_pred", "score", "cross_entropy", "n_events", "rejected"]


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel = model.value
        scorer = Scorer(m)
        for batch in batches:
            others = [c for c in batch.schema.names if c != "body"]
            for block in blocks(batch.column("body")):
                cost, n = scorer.texts(block)
                to = slice(block.first, block.first + block.n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c)[to] for c in others] + _decide(cost, n, m.languages, m.accepted), names=others + _DECIDED)

    return run


_PREDICTED = "lang_pred string, score double, cross_entropy double, n_events long, rejected boolean"


def fit_language_models(training: DataFrame, text_col: str = "text", lang_col: str = "lang",
                        model_grams: int = MODEL_GRAMS) -> LanguageModel | TabledModel:
    """Models of every non-null value of ``lang_col``; no row gives no model."""
    rows = training.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("body")).filter(
        "lang is not null and body is not null")
    counts = materialise(rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")), "ngrams")
    if counts.count() > model_grams:
        return _tabled(counts)
    table = counts.toArrow()  # at most model_grams rows
    lang = table.column("lang").to_numpy()
    gram = table.column("gram").to_numpy().view(np.uint64)
    n = table.column("n").to_numpy()
    names = sorted(set(lang.tolist()))
    vocabulary = len(np.unique(gram & np.uint64(0xFFFF))) + 1 if len(gram) else 1
    models = []
    for name in names:
        mine = lang == name
        models.append(KneserNey.fit(*_summed(gram[mine], n[mine]), vocabulary))
    return LanguageModel(names, models)


# ------------------------------------------------- models beyond a broadcast ---

@dataclass
class TabledModel:
    """The models as a table (lang, kind, key, value): kind 2 * order has the
    log probability of an n-gram, kind 2 * order + 1 the log back-off weight of
    a context; ``unseen`` is the log probability of a new character."""

    languages: list[str]
    table: DataFrame
    unseen: dict[str, float]
    accepted: dict[str, Accepted] | None = None


def _tail(key: Column, order: int) -> Column:
    """The last ``order`` characters."""
    return key if order == ORDER else key.bitwiseAND(F.lit((1 << (16 * order)) - 1))


def _tabled(counts: DataFrame) -> TabledModel:
    """``KneserNey.fit`` as groupings and joins."""
    vocabulary = counts.select(_tail(F.col("gram"), 1).alias("c")).distinct().count() + 1
    levels = [counts.select("lang", "gram", F.col("n").cast("double").alias("n"))]
    for order in range(ORDER - 1, 0, -1):
        levels.insert(0, materialise(levels[0].select("lang", _tail(F.col("gram"), order).alias("gram")).groupBy(
            "lang", "gram").agg(F.count(F.lit(1)).cast("double").alias("n")), "ngrams"))
    parts, lower, unseen = [], None, {}
    for order, level in enumerate(levels, 1):
        some = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).collect()
        discount = {r["lang"]: min(0.99, max(0.05, r["n1"] / (r["n1"] + 2 * r["n2"]))) if r["n1"] else 0.05 for r in some}
        d = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(discount.items()) for x in pair]), F.col("lang"))
        keyed = level.withColumn("context", F.shiftrightunsigned("gram", 16))
        context = keyed.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("size")).withColumn(
            "weight", d * F.col("size") / F.col("total"))
        if order == 1:
            unseen = {r["lang"]: float(np.log(r["weight"] / vocabulary)) for r in context.collect()}  # one context a language
            based = keyed.withColumn("lower", F.lit(1.0 / vocabulary))
        else:
            based = keyed.withColumn("tail", _tail(F.col("gram"), order - 1)).join(
                lower.select("lang", F.col("gram").alias("tail"), F.col("p").alias("lower")), ["lang", "tail"])
        lower = materialise(based.join(context, ["lang", "context"]).select(
            "lang", "gram", (F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("lower")).alias("p")), "kn")
        parts += [lower.select("lang", F.lit(2 * order).alias("kind"), F.col("gram").alias("key"), F.log("p").alias("value")),
                  context.select("lang", F.lit(2 * order + 1).alias("kind"), F.col("context").alias("key"), F.log("weight").alias("value"))]
    return TabledModel(sorted(unseen), materialise(reduce(DataFrame.unionByName, parts), "model"), unseen)


def _gram_costs(grams: DataFrame, model: TabledModel) -> DataFrame:
    """(gram, cost by language) of distinct 4-grams: one probe per step of the
    back-off chain, all in one join."""
    probes = []
    for order in range(ORDER, 0, -1):
        own = _tail(F.col("gram"), order)
        probes.append(F.struct(F.lit(2 * order).alias("kind"), own.alias("key")))
        if order > 1:
            probes.append(F.struct(F.lit(2 * order + 1).alias("kind"), F.shiftrightunsigned(own, 16).alias("key")))
    asked = grams.select("gram", F.explode(F.array(*probes)).alias("p")).select("gram", "p.kind", "p.key")
    # One row per key of the model: its values by language.
    known = model.table.groupBy("kind", "key").agg(F.map_from_entries(F.collect_list(F.struct("lang", "value"))).alias("values"))
    found = asked.join(known, ["kind", "key"], "left").groupBy("gram").agg(
        *[F.max(F.when(F.col("kind") == kind, F.col("values")[lang])).alias(f"k{kind}_{i}")
          for kind in range(2, 2 * ORDER + 2) if kind != 3 for i, lang in enumerate(model.languages)])
    costs = []
    for i, lang in enumerate(model.languages):
        log_p = F.lit(model.unseen[lang])
        for order in range(1, ORDER + 1):
            back = F.coalesce(F.col(f"k{2 * order + 1}_{i}"), F.lit(0.0)) if order > 1 else F.lit(0.0)
            log_p = F.coalesce(F.col(f"k{2 * order}_{i}"), back + log_p)
        costs.append(-log_p)
    return found.select("gram", F.array(*costs).alias("costs"))


def _text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its distinct words and their numbers; a task's new words come
    with their letters."""
    seen: set[int] = set()
    for batch in batches:
        others = [c for c in batch.schema.names if c != "body"]
        for block in blocks(batch.column("body")):
            w = words(block, _NO_LETTER)
            text = np.repeat(np.arange(block.n), w.counts)
            order = np.lexsort((w.hash, text))
            first = np.ones(len(order), bool)
            first[1:] = (w.hash[order[1:]] != w.hash[order[:-1]]) | (text[order[1:]] != text[order[:-1]])
            head = np.flatnonzero(first)
            times = np.diff(np.append(head, len(order)))
            some, owner = order[head], text[order[head]]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=block.n))])
            if len(seen) > _FLUSH // 4:
                seen.clear()
            raw, letters = block.data.tobytes(), []
            for i, h in zip(some.tolist(), w.hash[some].tolist(), strict=True):
                letters.append(None if h in seen else raw[w.start[i]:w.end[i]])
                seen.add(h)
            lists = [pa.array(w.hash[some].view(np.int64)), pa.array(times.astype(np.int64)), pa.array(letters, pa.binary()).cast(pa.string())]
            at = pa.array(offsets.astype(np.int32))
            to = slice(block.first, block.first + block.n)
            yield pa.RecordBatch.from_arrays([batch.column(c)[to] for c in others] + [pa.ListArray.from_arrays(at, x) for x in lists],
                                             names=[*others, "words", "times", "letters"])


def _word_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("word").to_numpy()
        for block in blocks(batch.column("letters")):
            w = words(block, _NO_LETTER)
            key, word = word_grams(block, w, np.arange(len(w.hash)))
            of = np.repeat(np.arange(block.n), w.counts)
            yield pa.RecordBatch.from_arrays([pa.array(ids[block.first + of[word]]), pa.array(key.view(np.int64))], names=["word", "gram"])


def _predict_tabled(chosen: DataFrame, model: TabledModel) -> DataFrame:
    """``chosen`` (kept columns and body) with the predicted columns."""
    kept = chosen.columns[:-1]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    texts = materialise(chosen.withColumn("_row", F.monotonically_increasing_id()).select(*kept, "_row", "body").mapInArrow(
        _text_words, f"{types + ', ' if types else ''}_row long, words array<long>, times array<long>, letters array<string>"), "words")
    held = texts.select("_row", F.explode(F.arrays_zip("words", "times", "letters")).alias("w")).select(
        "_row", F.col("w.words").alias("word"), F.col("w.times").alias("times"), F.col("w.letters").alias("letters"))
    known = held.filter("letters is not null").groupBy("word").agg(F.min("letters").alias("letters"))
    events = materialise(known.mapInArrow(_word_grams, "word long, gram long").groupBy("word", "gram").agg(
        F.count(F.lit(1)).alias("n")), "word_grams")
    costs = _gram_costs(events.select("gram").distinct(), model)
    n_lang = len(model.languages)
    by_word = events.join(costs, "gram").groupBy("word").agg(
        F.sum("n").alias("events"), F.array(*[F.sum(F.col("n") * F.col("costs")[i]) for i in range(n_lang)]).alias("costs"))
    # A word may be in every text: its rows are dealt over SALTS parts.
    salted = materialise(by_word, "word_costs").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = held.select("_row", "word", "times", F.pmod(F.xxhash64("_row"), F.lit(SALTS)).cast("int").alias("_salt"))
    summed = dealt.join(salted.hint("merge"), ["word", "_salt"]).groupBy("_row").agg(
        F.sum(F.col("times") * F.col("events")).alias("_events"),
        F.array(*[F.sum(F.col("times") * F.col("costs")[i]) for i in range(n_lang)]).alias("_costs"))
    languages, accepted = model.languages, model.accepted

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("_events").to_numpy().astype(float)
            cost = np.zeros((len(n), n_lang))
            some = np.flatnonzero(n > 0)
            cost[some] = batch.column("_costs").flatten().to_numpy().reshape(-1, n_lang)[:len(some)] if len(some) else 0
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + _decide(cost, n, languages, accepted), names=kept + _DECIDED)

    joined = texts.select(*kept, "_row").join(summed, "_row", "left").withColumn("_events", F.coalesce("_events", F.lit(0))).withColumn(
        "_costs", F.when(F.col("_events") > 0, F.col("_costs")))
    return joined.select(*kept, "_events", "_costs").mapInArrow(decide, f"{types + ', ' if types else ''}{_PREDICTED}")


def calibrate(training: DataFrame, model: LanguageModel | TabledModel, text_col: str = "text", lang_col: str = "lang",
              quantile: float = REJECT_QUANTILE, widths: float = REJECT_WIDTHS,
              margin: float = REJECT_MARGIN) -> LanguageModel | TabledModel:
    """Adds each language's accepted cross-entropies, from all training rows
    that are predicted right.

    The excess of a row is its cross-entropy over the language's mean per event,
    times the root of its events: lengths have about the same spread of it.
    """
    rows = training.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    seen = materialise(predict_language(rows, replace(model, accepted=None), keep=("lang",)).filter(
        "lang = lang_pred and n_events > 0").select("lang", "cross_entropy", "n_events"), "calibration")
    mean = {r["lang"]: r["mean"] for r in seen.groupBy("lang").agg(
        (F.sum(F.col("cross_entropy") * F.col("n_events")) / F.sum("n_events")).alias("mean")).collect()}  # one row per language
    if not mean:
        return replace(model, accepted={})
    means = F.create_map(*[F.lit(x) for pair in sorted(mean.items()) for x in pair])
    excess = (F.col("cross_entropy") - F.element_at(means, F.col("lang"))) * F.sqrt("n_events")
    stats = seen.select("lang", F.floor(F.log2("n_events")).cast("int").alias("length"), excess.alias("excess")).rollup(
        "lang", "length").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("excess", [0.25, 0.75, quantile], 10_000).alias("q")
                              ).filter("lang is not null").collect()  # languages x powers of two
    accepted = {lang: Accepted(x, 0.0, {}, margin) for lang, x in mean.items()}
    for r in stats:
        low, high, top = r["q"]
        bound = top + widths * (high - low)
        if r["length"] is None:
            accepted[r["lang"]].excess = bound
        elif r["n"] >= _BIN_ROWS:
            accepted[r["lang"]].by_length[r["length"]] = bound
    return replace(model, accepted=accepted)


def predict_language(docs: DataFrame, model: LanguageModel | TabledModel, text_col: str = "text",
                     keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and lang_pred, score, cross_entropy, n_events, rejected.

    Null and empty texts and texts without a letter are ``und`` with score 0
    and are rejected; without any model every text is.  Equal cross-entropies
    give the language that sorts first.
    """
    chosen = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    if isinstance(model, TabledModel):
        return _predict_tabled(chosen, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(_predict(shared), f"{types}, {_PREDICTED}")


def held_out(id_col: str = "doc_id"):
    """The fixed fold: crc32 of the id as text, modulo 5, is 0 (null: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                model_grams: int = MODEL_GRAMS) -> DataFrame:
    """Learn from the rows outside the held-out fold and predict every row:
    doc_id, held_out, lang_pred, score, and the columns of ``predict_language``.

    Null ids are never held out; repeated rows each have their row; an empty
    table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang"), held_out(id_col).alias("held_out"))
    training = rows.filter("not held_out and lang is not null")
    model = calibrate(training, fit_language_models(training, model_grams=model_grams))
    return predict_language(rows, model, keep=("doc_id", "held_out"))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows whose language is rejected; columns stay."""
    training = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull())
    model = calibrate(training, fit_language_models(training, text_col, lang_col), text_col, lang_col)
    whole = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return predict_language(whole, model, keep=("row",)).filter("not rejected").select("row.*")
