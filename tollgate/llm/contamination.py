"""Benchmark passages inside documents by size-partitioned MinHash containment.

A set's sketch is one-permutation MinHash: the hash range is split into bins
and each bin's least hash is a coordinate.  Similarity of a short item and a
long document is tiny, so documents are partitioned by the size of their set
(powers of two) and each partition's sketch has 1 / LOAD bins per element of
its largest size.  Whatever the document's length, a shingle that it shares
with an item then is a coordinate with probability of at least
``(1 - exp(-LOAD)) / LOAD``, independently of the rest of the text.

The number of an item's shingles found among a document's coordinates
estimates its containment.  A pair is a candidate when the number reaches the
item's bound, chosen so that an item at the containment threshold falls short
of it with a probability of at most MISS.  Items too short for any bound are
looked up at full resolution (a bin per element).  Candidates are confirmed by
exact containment of the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.staging import materialise
from tollgate.llm.textarrays import blocks, distinct_by_text, shingles, words

SHINGLE = 5
THRESHOLD = 75  # per cent of the item's shingles
LOAD, MISS = 0.5, 1e-6
#: Item shingles that a task may hold as a sorted array (8 bytes each) to emit
#: only coordinates that some item has; with more, all coordinates are shuffled.
LOOKUP = 2_000_000


def needed(n: int, threshold: int = THRESHOLD, load: float = LOAD, miss: float = MISS) -> int:
    """Coordinates that make an n-shingle item a candidate; 0: full resolution."""
    shared = ceil(threshold * n / 100)
    p = (1 - exp(-load)) / load
    below, bound = 0.0, 0
    for c in range(shared + 1):
        below += comb(shared, c) * p ** c * (1 - p) ** (shared - c)
        if below > miss:
            break
        bound = c + 1
    return bound


def coordinates(values: np.ndarray, offsets: np.ndarray, load: float = LOAD) -> np.ndarray:
    """Which of each text's sorted distinct hashes are least in their bin; the
    bins are those of the text's size partition."""
    size = np.maximum(np.diff(offsets), 1)
    bins = np.ceil(np.log2(size)).astype(np.int64) + round(np.log2(1 / load))
    shift = np.repeat(64 - np.minimum(bins, 63), np.diff(offsets)).astype(np.uint64)
    place = np.where(shift > 63, np.uint64(0), values >> np.minimum(shift, np.uint64(63)))
    least = np.ones(len(values), bool)
    least[1:] = place[1:] != place[:-1]
    least[offsets[:-1][np.diff(offsets) > 0]] = True
    return least


def _item_sets(k: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("body")):
                values, offsets = distinct_by_text(*shingles(words(block), k))
                size = np.diff(offsets)
                to = slice(block.first, block.first + block.n)
                yield pa.RecordBatch.from_pydict({
                    "item": batch.column("item")[to], "item_id": batch.column("item_id")[to],
                    "n_item": pa.array(size.astype(np.int64)),
                    "least": pa.array([needed(n, threshold) if n < 1000 else max(1, n // 4) for n in size.tolist()], pa.int64()),
                    "grams": pa.LargeListArray.from_arrays(offsets, values.view(np.int64)).cast(pa.list_(pa.int64()))})

    return run


def _held(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def _probe(k: int, lookup):
    """Per document with a hit: its text, coordinates, and full-resolution
    hashes; without a lookup every coordinate counts as a hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = lookup.value if lookup is not None else None
        for batch in batches:
            for block in blocks(batch.column("body")):
                values, offsets = distinct_by_text(*shingles(words(block), k))
                least = coordinates(values, offsets)
                if sets is not None:
                    coarse, fine = least & _held(sets[0], values), _held(sets[1], values)
                else:
                    coarse, fine = least, ~least
                owner = np.repeat(np.arange(block.n), np.diff(offsets))
                some = np.flatnonzero(np.bincount(owner[coarse | fine], minlength=block.n))
                if not len(some):
                    continue

                def lists(chosen: np.ndarray) -> pa.Array:
                    per = np.bincount(owner[chosen], minlength=block.n)[some]
                    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32)),
                                                    pa.array(values[chosen].view(np.int64)))

                rows = pa.array(block.first + some)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(rows) for c in ("row", "doc_id", "body")] + [lists(coarse), lists(fine)],
                    names=["row", "doc_id", "body", "coarse", "fine"])

    return run


def _confirm(k: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                x = batch.column("row").to_numpy()
                starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))  # a text once per run of its items
                sets = []
                for block in blocks(batch.column("body").take(pa.array(starts))):
                    values, offsets = distinct_by_text(*shingles(words(block), k))
                    sets += [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                of = np.searchsorted(starts, np.arange(batch.num_rows), side="right") - 1
                grams = batch.column("grams")
                common = [int(_held(sets[of[i]], grams[i].values.to_numpy().view(np.uint64)).sum())
                          for i in range(batch.num_rows)]
                n = batch.column("n_item").to_numpy()
                keep = pa.array(100 * np.array(common, np.int64) >= threshold * n)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("doc_id", "item_id", "n_item")), pa.array(common, pa.int64()),
                     batch.column("content")], names=["doc_id", "item_id", "n_item", "n_common", "content"]).filter(keep)

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", k: int = SHINGLE,
                  threshold: int = THRESHOLD, lookup_limit: int = LOOKUP) -> DataFrame:
    """One row per (document row, item row) whose containment reaches the
    threshold: doc_id, item_id, n_item, n_common, containment, content.

    Words and shingles are those of the near-duplicate operator; ``content``
    is ``xxhash64(text)`` and finds the row again where ids are null or
    repeated.  Null, empty and word-less texts and items match nothing;
    repeated documents or items each give their rows; an empty table on
    either side gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    items = materialise(benchmark.select(
        F.monotonically_increasing_id().alias("item"), F.col(item_id_col).cast("long").alias("item_id"),
        F.coalesce(F.col(item_text_col), F.lit("")).alias("body")).mapInArrow(
        _item_sets(k, threshold), "item long, item_id long, n_item long, least long, grams array<long>"), "items")
    gram = items.select("item", "least", F.explode("grams").alias("gram"))
    lookup = None
    small = (items.agg(F.sum("n_item")).first()[0] or 0) <= lookup_limit
    if small:
        sets = [np.sort(np.array([r[0] for r in gram.filter(f"least {op} 0").select("gram").distinct().collect()],
                                 np.int64).view(np.uint64)) for op in (">", "=")]
        lookup = spark.sparkContext.broadcast(sets)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    probed = materialise(rows.mapInArrow(
        _probe(k, lookup), "row long, doc_id long, body string, coarse array<long>, fine array<long>"), "probed")
    sided = F.broadcast(gram) if small else gram
    coarse = probed.select("row", F.explode("coarse").alias("gram"), F.lit(True).alias("is_coordinate"))
    hits = coarse.unionByName(probed.select("row", F.explode("fine").alias("gram"), F.lit(False).alias("is_coordinate")))
    # Coordinates count for every item when nothing was looked up before, other hashes for the short items only.
    of_kind = F.col("is_coordinate") == (F.col("least") > 0) if small else F.col("is_coordinate") | (F.col("least") == 0)
    counted = hits.join(sided, "gram").filter(of_kind).groupBy("row", "item", "least").agg(F.count(F.lit(1)).alias("hits"))
    candidates = counted.filter(F.col("hits") >= F.greatest("least", F.lit(1))).select("row", "item")
    texts = probed.select("row", "doc_id", "body", F.xxhash64("body").alias("content"))
    sets = items.select("item", "item_id", "n_item", "grams")
    paired = candidates.join(F.broadcast(sets) if small else sets, "item").join(texts, "row")
    return paired.mapInArrow(
        _confirm(k, threshold), "doc_id long, item_id long, n_item long, n_common long, content long").withColumn(
        "containment", F.col("n_common") / F.col("n_item"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay."""
    found = materialise(contamination(docs, benchmark, id_col, text_col, **options)
                        .select(F.col("doc_id").alias("_found_id"), F.col("content").alias("_found_content"))
                        .distinct(), "contaminated")
    return docs.join(found, F.col(id_col).cast("long").eqNullSafe(F.col("_found_id")) & (
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("_found_content")), "left_anti")


ORACLE_SQL = r"""
WITH x AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM x),
s AS (SELECT kind, id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
                      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
d AS (SELECT id AS doc_id, unnest(g) AS g FROM s WHERE kind = 'd'),
i AS (SELECT id AS item_id, len(g) AS n_item, unnest(g) AS g FROM s WHERE kind = 'i')
SELECT doc_id, item_id, CAST(any_value(n_item) AS BIGINT) AS n_item, count(*) AS n_common,
       count(*) / any_value(n_item) AS containment
FROM d JOIN i USING (g) GROUP BY doc_id, item_id HAVING 100 * count(*) >= 75 * any_value(n_item)
"""
