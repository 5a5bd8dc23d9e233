"""Ranked lexical search, term at a time with limited accumulators.

The documents are read once into postings of the query terms (document by
document, in the shared folder) and the corpus statistics.  Every task inverts
its documents slice by slice and answers all items on each slice.  An item's
terms are taken rarest first.  A document gets an accumulator when one of them
occurs in it.  Every term has a bound, its largest contribution in the slice;
once the bounds of the remaining terms together cannot reach the k-th best
partial score, no accumulator is created any more.  The survivors are updated
exactly to the end.  The k-th score of earlier slices of the task counts too.
A task sends its k best documents of each item, and Spark ranks them.

A document that has no accumulator cannot be among the k best: its score is at
most the remaining bounds.  The comparison is strict, so ties are kept.

Items go to the tasks in blocks of at most BLOCK_TERMS terms (a longer item is
a block of its own): what is broadcast has a bound, and a larger query table
makes more rounds over the documents.  Terms are told apart by 64-bit hashes
of their bytes, so results hold up to random collisions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.staging import materialise
from tollgate.llm.textarrays import NON_ALNUM, blocks, words

K = 10
BLOCK_TERMS = 1 << 18
SLICE_DOCS, SLICE_POSTINGS = 1 << 15, 1 << 22
DOCS_PER_TASK = 1 << 14  # at least, when there are more than cores need


@dataclass
class Items:
    """A block of items; terms are numbered by their sorted hashes."""

    row: list[int]
    item_id: list[int | None]
    hashes: np.ndarray
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


def _tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column("body")):
            w = words(block, NON_ALNUM)
            to = slice(block.first, block.first + block.n)
            yield pa.RecordBatch.from_arrays([
                batch.column("item")[to], batch.column("item_id")[to],
                pa.ListArray.from_arrays(pa.array(w.offsets.astype(np.int32)), pa.array(w.hash.view(np.int64)))],
                names=["item", "item_id", "hashes"])


def _item_blocks(items: DataFrame, most: int) -> Iterator[Items]:
    """Items row by row from the staged table, in blocks of at most ``most`` terms."""
    rows, size = [], 0
    for r in items.toLocalIterator():
        if not r["hashes"]:
            continue
        if rows and size + len(r["hashes"]) > most:
            yield _items(rows)
            rows, size = [], 0
        rows.append(r)
        size += len(r["hashes"])
    if rows:
        yield _items(rows)


def _items(rows: list) -> Items:
    own = [np.array(r["hashes"], np.int64).view(np.uint64) for r in rows]
    hashes = np.unique(np.concatenate(own))
    terms, repeats = [], []
    for h in own:
        t, n = np.unique(np.searchsorted(hashes, h), return_counts=True)
        terms.append(t)
        repeats.append(n)
    return Items([r["item"] for r in rows], [r["item_id"] for r in rows], hashes, terms, repeats)


INDEX_SCHEMA = "stat boolean, doc_id long, n long, docs long, terms array<int>, counts array<int>"


def _index(shared):
    """A row per document with a query term: its length and the counts of its
    query terms; at the end one row with the task's statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = shared.value
        width = len(hashes)
        front = np.zeros(1 << 20, bool)
        front[(hashes >> np.uint64(44)).astype(np.int64)] = True
        df = np.zeros(width, np.int64)
        total = held = 0
        for batch in batches:
            ids = batch.column("doc_id")
            for block in blocks(batch.column("body")):
                w = words(block, NON_ALNUM)
                n = w.counts
                total += int(n.sum())
                held += int((n > 0).sum())
                text = np.repeat(np.arange(block.n), n)
                maybe = np.flatnonzero(front[(w.hash >> np.uint64(44)).astype(np.int64)])
                term = np.minimum(np.searchsorted(hashes, w.hash[maybe]), width - 1)
                hit = hashes[term] == w.hash[maybe]
                key, count = np.unique(text[maybe[hit]] * width + term[hit], return_counts=True)
                owner, term = key // width, key % width
                df += np.bincount(term, minlength=width)
                per = np.bincount(owner, minlength=block.n)
                some = np.flatnonzero(per)
                offsets = pa.array(np.concatenate([[0], np.cumsum(per[some])]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.zeros(len(some), bool)), ids.take(pa.array(some + block.first)), pa.array(n[some].astype(np.int64)),
                    pa.nulls(len(some), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32)))],
                    names=["stat", "doc_id", "n", "docs", "terms", "counts"])
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([
            pa.array([True]), pa.nulls(1, pa.int64()), pa.array([total]), pa.array([held]),
            pa.array([seen.astype(np.int32)], pa.list_(pa.int32())), pa.array([df[seen].astype(np.int32)], pa.list_(pa.int32()))],
            names=["stat", "doc_id", "n", "docs", "terms", "counts"])

    return run


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Plan:
    """An item block with its corpus statistics."""

    items: Items
    weight: np.ndarray  # by term
    order: list[np.ndarray]  # by item: places of its terms, rarest first
    n_docs: int
    n_words: int
    k: int


class Slice:
    """Inverted postings of some documents: contribution of each posting by
    term, and each term's largest."""

    def __init__(self, plan: Plan, lengths: np.ndarray, owner: np.ndarray, terms: np.ndarray, counts: np.ndarray):
        order = np.argsort(terms, kind="stable")
        self.owner = owner[order]
        norm = 25 + (75 * lengths * plan.n_docs) // max(plan.n_words, 1)
        tf = counts[order].astype(np.int64)
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * norm[self.owner])
        own = terms[order]
        self.gain = plan.weight[own] * impact
        present, first = np.unique(own, return_index=True)
        self.lo = dict(zip(present.tolist(), first.tolist(), strict=True))
        self.hi = dict(zip(present.tolist(), [*first[1:].tolist(), len(own)], strict=True))
        self.bound = dict(zip(present.tolist(), np.maximum.reduceat(self.gain, first).tolist() if len(own) else [], strict=True))
        self.scores = np.zeros(len(lengths), np.int64)

    def answer(self, terms: list[int], repeats: list[int], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the slice that can be among the k best, and their
        scores; ``least`` is a score that k documents elsewhere have."""
        here = [(t, r) for t, r in zip(terms, repeats, strict=True) if self.bound.get(t)]
        remaining = sum(self.bound[t] * r for t, r in here)
        scores, found, open_ = self.scores, [], True
        alive = np.zeros(0, np.int64)
        for t, r in here:
            lo, hi = self.lo[t], self.hi[t]
            docs, gain = self.owner[lo:hi], self.gain[lo:hi] * r
            if open_:
                n = sum(map(len, found))
                threshold = least
                if n >= k:
                    alive = np.concatenate(found)
                    threshold = max(least, int(np.partition(scores[alive], n - k)[n - k]))
                if remaining < threshold:
                    open_ = False
                    alive = np.sort(np.concatenate(found)) if found else alive
            if open_:
                found.append(docs[scores[docs] == 0])
                scores[docs] += gain
            elif len(alive) * 8 < len(docs):
                at = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
                held = docs[at] == alive
                scores[alive[held]] += gain[at[held]]
            else:
                held = scores[docs] > 0
                scores[docs[held]] += gain[held]
            remaining -= self.bound[t] * r
        alive = np.concatenate(found) if found else alive
        out = scores[alive].copy()
        scores[alive] = 0
        if len(out) > k:
            best = out >= np.partition(out, len(out) - k)[len(out) - k]
            alive, out = alive[best], out[best]
        return alive, out


def _best(score: np.ndarray, doc: np.ndarray, known: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: by score, then by id, null ids last."""
    return np.lexsort((doc, ~known, -score))[:k]


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Plan = shared.value
        k, items = plan.k, plan.items
        n_items = len(items.row)
        terms = [items.terms[i][plan.order[i]].tolist() for i in range(n_items)]
        repeats = [items.repeats[i][plan.order[i]].tolist() for i in range(n_items)]
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        best = [empty] * n_items
        held: list[pa.RecordBatch] = []

        def answer() -> None:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            doc = ids.fill_null(0).to_numpy()
            per = np.diff(batch.column("terms").offsets.to_numpy())
            part = Slice(plan, batch.column("n").to_numpy(), np.repeat(np.arange(len(doc)), per),
                         batch.column("terms").flatten().to_numpy(), batch.column("counts").flatten().to_numpy())
            for i in range(n_items):
                old = best[i]
                least = int(old[0][-1]) if len(old[0]) == k else 0
                at, score = part.answer(terms[i], repeats[i], k, least)
                if len(at):
                    score, d, g = (np.concatenate(x) for x in zip(old, (score, doc[at], known[at]), strict=True))
                    first = _best(score, d, g, k)
                    best[i] = (score[first], d[first], g[first])

        docs = postings = 0
        for batch in batches:
            step = max(1, SLICE_DOCS // 4)
            for at in range(0, batch.num_rows, step):
                piece = batch.slice(at, step)
                held.append(piece)
                docs += piece.num_rows
                postings += len(piece.column("terms").flatten())
                if docs >= SLICE_DOCS or postings >= SLICE_POSTINGS:
                    answer()
                    held.clear()
                    docs = postings = 0
        if held:
            answer()
        out = [(items.row[i], items.item_id[i], int(d) if g else None, int(s))
               for i in range(n_items) for s, d, g in zip(*best[i], strict=True)]
        if out:
            row, item_id, doc, score = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (row, item_id, doc, score)],
                                             names=["item", "item_id", "doc_id", "score"])

    return run


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", query_col: str = "text", k: int = K,
                  block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score
    above 0 (fewer, if there are fewer), equal scores by ascending doc_id.

    Every row of ``items`` is an item of its own, also where ids repeat or are
    null.  Null and empty texts have no terms: such documents are never found
    and such items have no rows.  Documents with equal ids are told apart, null
    ids rank last among equal scores.  Without documents or items the result is
    empty; other columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    queries = materialise(items.select(
        F.monotonically_increasing_id().alias("item"), F.col(item_col).cast("long").alias("item_id"),
        F.coalesce(F.col(query_col), F.lit("")).alias("body")).mapInArrow(
            _tokenize, "item long, item_id long, hashes array<long>"), "search-items")
    found = None
    for block in _item_blocks(queries, block_terms):
        part = _answers(source, block, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _answers(source: DataFrame, block: Items, k: int) -> DataFrame:
    spark = source.sparkSession
    index = materialise(source.mapInArrow(_index(spark.sparkContext.broadcast(block.hashes)), INDEX_SCHEMA), "search-index")
    stat = index.filter("stat")
    size = stat.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    # One row per term of the block, which BLOCK_TERMS bounds.
    counted = stat.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms").agg(
        F.sum("t.counts").alias("df")).toArrow()
    df = np.zeros(len(block.hashes), np.int64)
    df[counted.column(0).to_numpy()] = counted.column(1).to_numpy()
    weight = np.array([term_weight(size["docs"], int(n)) for n in df], np.int64)
    order = [np.lexsort((t, df[t])) for t in block.terms]
    plan = spark.sparkContext.broadcast(Plan(block, weight, order, size["docs"], size["words"], k))
    # A slice serves all items at once: few large tasks beat many small ones.
    tasks = max(spark.sparkContext.defaultParallelism, -(-size["docs"] // DOCS_PER_TASK))
    return index.filter("not stat").select("doc_id", "n", "terms", "counts").coalesce(tasks).mapInArrow(
        _search(plan), "item long, item_id long, doc_id long, score long")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = f"""
WITH i AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS ws FROM benchmark),
q AS (SELECT item, item_id, term, count(*) AS qtf FROM (SELECT item, item_id, unnest(ws) AS term FROM i) GROUP BY ALL),
d AS (SELECT row_number() OVER () AS doc, doc_id, {_TERMS} AS ws FROM documents),
size AS (SELECT count(*) AS n_docs, sum(len(ws)) AS n_words FROM d WHERE len(ws) > 0),
tf AS (SELECT doc, doc_id, n, term, count(*) AS tf FROM (SELECT doc, doc_id, len(ws) AS n, unnest(ws) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, size),
s AS (SELECT item, item_id, doc, doc_id,
             CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_words)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term), size GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= {K}
"""
