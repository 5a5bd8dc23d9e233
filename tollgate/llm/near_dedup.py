"""Near-duplicate groups by fast similarity sketching, banding and exact checks.

A document's set is its distinct word shingles.  The sketch has T coordinates.
Round i hashes every element to a bin and a value: in the first T rounds the
bin is random, in round T + j it is bin j.  A coordinate holds the least
``(round, value)`` that it has met, so every coordinate is filled after at
most 2 T rounds, and the share of equal coordinates of two sketches
concentrates around the similarity as for T independent hash functions.

BANDS bands of T / BANDS coordinates make the bucket keys.  Within a bucket
every set is compared to one pivot only, the set that meets most others in all
its buckets: of edited copies that is the original, or the least edited one.
Links are confirmed on the full sets.  Buckets whose sets do not end in one
component are taken up once more with a random pivot.  So a group of thousands
of copies costs about one comparison for each member and bucket.

What a bucket then still has in different components may be linked by pairs
without a pivot, or may be alike but not enough, like copies with many edits
each, of which there are as many pairs as the square of the group.  Those sets
are joined on the rare ends of their sorted sets: for two sets of sizes a and b
to have the similarity, ``o = ceil(t (a + b) / (1 + t))`` shingles must be
common, so the first ``a - o + 1`` and ``b - o + 1`` shingles, sorted by
frequency, must meet.  Copies with many edits begin with their own shingles and
do not meet.  No candidate is left out.

Documents with equal sets are one node of the graph; within an input task
they are grouped first, so a hot set sends one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.graph import connected_components
from tollgate.llm.staging import materialise
from tollgate.llm.textarrays import blocks, distinct_by_text, mix, shingles, words

SHINGLE = 5
THRESHOLD = 75  # per cent
T, BANDS = 128, 32
PIVOT_ROUNDS = 1  # with random pivots
SIZE_STEP = 0.02  # of the size classes in which rare ends are joined
LOCAL_SETS = 500_000  # sets that a task remembers to group its own copies

_ROUND = mix(np.arange(1, 2 * T + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_FOLD = np.uint64(0xC2B2AE3D27D4EB4F)


def sketch(values: np.ndarray, offsets: np.ndarray, t: int = T) -> np.ndarray:
    """Fast similarity sketches of non-empty sets; one row of t coordinates each."""
    n = len(offsets) - 1
    out = np.full((n, t), _EMPTY)
    flat = out.reshape(-1)
    size = np.diff(offsets)
    owner = np.repeat(np.arange(n), size)
    open_sets = np.ones(n, bool)
    for i in range(2 * t):
        h = mix(values ^ _ROUND[i % len(_ROUND)])
        place = h & np.uint64(t - 1) if i < t else np.full(len(h), i - t, np.uint64)
        value = (np.uint64(i) << np.uint64(55)) | (h >> np.uint64(9))
        np.minimum.at(flat, owner * t + place.astype(np.int64), value)
        still = (out == _EMPTY).any(axis=1)
        if not still.any():
            break
        if still.sum() < open_sets.sum():
            keep = still[owner]
            values, owner, open_sets = values[keep], owner[keep], still
    return out


def band_keys(sketches: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band; a key names its band too."""
    n, t = sketches.shape
    parts = sketches.reshape(n, bands, t // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands))
    for j in range(t // bands):
        key = mix(key * _FOLD + parts[:, :, j])
    return key.view(np.int64)


def _describe(k: int, t: int, bands: int):
    """Per row its set's size, 128-bit key and the first row of the task with
    that set; that row also has the band keys and the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for block in blocks(batch.column("body")):
                values, offsets = distinct_by_text(*shingles(words(block), k))
                size = np.diff(offsets)
                full = np.flatnonzero(size)
                own = rows[block.first:block.first + block.n]
                first = own.copy()
                key = np.zeros((2, block.n), np.uint64)
                if len(full):
                    for j in (0, 1):
                        key[j, full] = mix(np.add.reduceat(mix(values ^ _ROUND[j]), offsets[full]))
                new = []
                for i in full.tolist():
                    got = seen.setdefault((int(key[0, i]), int(key[1, i])), int(own[i]))
                    first[i] = got
                    if got == own[i]:
                        new.append(i)
                if len(seen) > LOCAL_SETS:
                    seen.clear()
                fresh = np.array(new, np.int64)
                lists = [None] * block.n
                if new:
                    part = size[fresh]
                    at = np.repeat(offsets[fresh] - np.concatenate([[0], np.cumsum(part)[:-1]]), part) + np.arange(part.sum())
                    keys = band_keys(sketch(values[at], np.concatenate([[0], np.cumsum(part)]), t), bands)
                    for i, row in zip(new, keys, strict=True):
                        lists[i] = row
                is_new = np.zeros(block.n, bool)
                is_new[fresh] = True
                # a null index takes a null
                text_of = pa.array(block.first + np.arange(block.n), mask=~is_new)
                yield pa.RecordBatch.from_arrays([
                    pa.array(own), batch.column("id").slice(block.first, block.n),
                    batch.column("content").slice(block.first, block.n), pa.array(size.astype(np.int64)),
                    pa.array(key[0].view(np.int64)), pa.array(key[1].view(np.int64)), pa.array(first),
                    pa.array(lists, pa.list_(pa.int64())),
                    batch.column("body").take(text_of)],
                    names=["row", "id", "content", "n", "ka", "kb", "first", "bands", "body"])

    return run


_DESCRIBED = "row long, id long, content long, n long, ka long, kb long, first long, bands array<long>, body string"


def _runs(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """Positions where a column's value differs from the row before."""
    x = batch.column(column).to_numpy()
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))


def _confirm(k: int, threshold: int):
    """Keeps the pairs whose full sets are similar enough."""

    def sets(column: pa.Array) -> list[np.ndarray]:
        out = []
        for block in blocks(column):
            values, offsets = distinct_by_text(*shingles(words(block), k))
            out += [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                starts = _runs(batch, "u")  # one set per run of equal pivots
                left = sets(batch.column("u_body").take(pa.array(starts)))
                pivot = np.searchsorted(starts, np.arange(batch.num_rows), side="right") - 1
                good = []
                for i, b in zip(pivot.tolist(), sets(batch.column("v_body")), strict=True):
                    a = left[i]
                    small, large = (a, b) if len(a) <= len(b) else (b, a)
                    if 100 * len(small) < threshold * len(large):
                        good.append(False)
                        continue
                    there = np.searchsorted(large, small)
                    common = int((large[np.minimum(there, len(large) - 1)] == small).sum())
                    good.append(100 * common >= threshold * (len(a) + len(b) - common))
                yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    return run


def links(pairs: DataFrame, texts: DataFrame, k: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The (u, v) pairs of rows whose sets are similar; ``texts`` has row, body."""
    wanted = pairs.select(F.col("u").alias("row")).unionByName(pairs.select(F.col("v").alias("row"))).distinct()
    # Pairs grow with the documents: the same kind of join at every size.
    needed = texts.join(wanted.hint("merge"), "row", "left_semi")
    u = needed.select(F.col("row").alias("u"), F.col("body").alias("u_body"))
    v = needed.select(F.col("row").alias("v"), F.col("body").alias("v_body"))
    both = pairs.select("u", "v").hint("merge").join(v, "v").join(u.hint("merge"), "u").select("u", "v", "u_body", "v_body")
    return both.mapInArrow(_confirm(k, threshold), "u long, v long")


def _shingle_lists(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("body")):
                values, offsets = distinct_by_text(*shingles(words(block), k))
                to = slice(block.first, block.first + block.n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node")[to], batch.column("component")[to], pa.array(np.diff(offsets).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))],
                    names=["node", "component", "n", "grams"])

    return run


def _size_class(n) -> F.Column:
    """Classes of set sizes: single sizes first, then steps of SIZE_STEP."""
    start = int(1 / SIZE_STEP)
    return F.when(n <= start, n).otherwise(start + F.floor(F.log(n / start) / np.log1p(SIZE_STEP))).cast("long")


def _least_of_class(c) -> F.Column:
    start = int(1 / SIZE_STEP)
    return F.when(c <= start, c.cast("double")).otherwise(start * F.pow(F.lit(1 + SIZE_STEP), c - start) - 1e-6)


def rare_end_pairs(nodes: DataFrame, texts: DataFrame, k: int, threshold: int) -> DataFrame:
    """(node, other) in different components that may be similar: those whose
    rare ends meet.  ``nodes`` has node, component."""
    sets = nodes.join(texts.withColumnRenamed("row", "node"), "node").select("node", "component", "body").mapInArrow(
        _shingle_lists(k), "node long, component long, n long, grams array<long>")
    grams = materialise(sets, "sets").select("node", "component", "n", F.explode("grams").alias("gram"))
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    ranked = grams.join(often, "gram").withColumn(
        "rank", F.row_number().over(Window.partitionBy("node").orderBy("df", "gram")))
    t = threshold / 100
    n = F.col("n")
    # Of a partner in the size class ``other`` at least ``least`` shingles, so at least ``o`` in common.
    o = F.ceil(t / (1 + t) * (n + _least_of_class(F.col("other"))) - 1e-6)
    ends = (ranked.filter((F.col("df") > 1) & (F.col("rank") <= n - F.ceil(t * n - 1e-6) + 1))
            .withColumn("own", _size_class(n))
            .withColumn("other", F.explode(F.sequence(_size_class(F.ceil(t * n - 1e-6)), _size_class(F.floor(n / t + 1e-6)))))
            .filter(F.col("rank") <= n - o + 1)
            .select("node", "component", "gram", "own", "other"))
    ends = materialise(ends, "rare_ends")
    key = ["gram", "own", "other"]  # met by the same shingle's rows with own and other exchanged
    sides = ends.groupBy(*key, "component").agg(F.count(F.lit(1)).alias("size"))
    both = sides.unionByName(sides.select("gram", F.col("own").alias("other"), F.col("other").alias("own"), "component", "size"))
    # Compared are the sets outside the key's largest component with all others.  Of equal
    # sizes the larger number counts, so both keys of a pair have the same main component.
    main = (both.groupBy(*key, "component").agg(F.sum("size").alias("size"))
            .groupBy(*key).agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("components"))
            .filter("components > 1").drop("components"))
    mixed = ends.join(main, key)
    outside = mixed.filter("component <> main").select(
        "gram", F.col("own").alias("other"), F.col("other").alias("own"), F.col("node").alias("met"),
        F.col("component").alias("theirs"))
    return mixed.join(outside, key).filter(
        (F.col("component") != F.col("theirs")) & ((F.col("component") == F.col("main")) | (F.col("node") < F.col("met")))
    ).select("node", F.col("met").alias("other"))


def _pairs(frame: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct pairs with the smaller row first."""
    return frame.filter(F.col(a) != F.col(b)).select(
        F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                threshold: int = THRESHOLD, t: int = T, bands: int = BANDS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, content, component
    (``xxhash64(text)``, which finds the row again where ids repeat).

    - Words are runs of non-white-space (ASCII), A-Z lower-cased; a text with
      fewer than k words is one shingle; null, empty and word-less texts have
      an empty set, link with nothing and are kept.
    - component_id is the smallest non-null id that is reachable over links
      (null if there is none); kept is doc_id = component_id, nulls equal, so
      a null id is kept only where its whole component has no id.  Repeated
      rows have the same result and are all kept or all dropped.
    - component is the group itself, whatever its ids are; null for an empty set.
    - An empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("body"),
                       F.xxhash64(F.col(text_col)).alias("content"))
    described = materialise(rows.mapInArrow(_describe(k, t, bands), _DESCRIBED), "described")

    # Nodes: distinct sets, named by their smallest row that has the text.
    local = described.filter("n > 0").groupBy("first", "ka", "kb").agg(F.min("id").alias("id"))
    node = local.groupBy("ka", "kb").agg(F.min("first").alias("node"), F.min("id").alias("best"))
    member = local.select("first", "ka", "kb").join(node, ["ka", "kb"]).select("first", "node")
    texts = described.filter("body is not null").select("row", "body")
    banded = materialise(node.select("node").join(described.filter("bands is not null").select(
        F.col("row").alias("node"), "bands"), "node"), "bands").select("node", F.explode("bands").alias("key"))

    buckets = materialise(banded.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("lo"), F.max("node").alias("hi")).filter("size > 1"), "buckets")
    large = materialise(banded.join(buckets.filter("size > 2").select("key", "size"), "key"), "large_buckets")
    meets = large.groupBy("node").agg(F.sum("size").alias("meets"))
    pivots = large.select("key", "node").join(meets, "node").groupBy("key").agg(
        F.max_by("node", F.struct("meets", "node")).alias("pivot"))
    first = materialise(_pairs(buckets.filter("size = 2"), "lo", "hi").unionByName(
        _pairs(large.join(pivots, "key"), "pivot", "node")).distinct(), "pairs")
    tried = [first]
    component = connected_components(materialise(links(first, texts, k, threshold), "links"))

    def joined(new: DataFrame, before: DataFrame) -> DataFrame:
        """Components with the confirmed ones of the new pairs."""
        found = materialise(links(new, texts, k, threshold), "links")
        if found.isEmpty():
            return before
        return connected_components(found.unionByName(before.select(F.col("node").alias("u"), F.col("component").alias("v"))))

    for turn in range(PIVOT_ROUNDS + 1):
        # Buckets whose sets are still in more than one component.
        labelled = large.select("key", "node").join(component, "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("component"))
        apart = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter(
            "lo < hi").select("key")
        rest = materialise(labelled.join(apart, "key"), "apart")
        if rest.isEmpty():
            break
        if turn < PIVOT_ROUNDS:
            salt = F.xxhash64(F.col("node"), F.lit(turn))
            pivot = rest.groupBy("key").agg(F.max_by(F.struct("node", "component"), salt).alias("p"))
            found = _pairs(rest.join(pivot, "key").filter("component <> p.component").select(
                "node", F.col("p.node").alias("pivot")), "node", "pivot")
        else:
            found = _pairs(rare_end_pairs(rest.select("node", "component").distinct(), texts, k, threshold), "node", "other")
        new = materialise(found.join(reduce(DataFrame.unionByName, tried), ["u", "v"], "left_anti"), "pairs")
        if not new.isEmpty():
            tried.append(new)
            component = joined(new, component)

    of_node = node.select("node", "best").join(component, "node", "left").select(
        "node", "best", F.coalesce("component", "node").alias("component"))
    least = of_node.groupBy("component").agg(F.min("best").alias("component_id"))
    resolved = member.join(of_node.join(least, "component").select("node", "component", "component_id"), "node")
    joined = described.select("id", "content", "n", "first").join(
        resolved.select("first", "component", "component_id"), "first", "left")
    component_id = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return joined.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                         component_id.alias("component_id"), "content", F.when(F.col("n") > 0, F.col("component")).alias("component")).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "content",
        "component")


def near_dedup(docs: DataFrame, *args, **options) -> DataFrame:
    """``near_groups`` without component."""
    return near_groups(docs, *args, **options).drop("component")


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
                      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS nu, any_value(b.n) AS nv, count(*) AS shared
      FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM c WHERE 100 * shared >= 75 * (nu + nv - shared)),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.v FROM r JOIN l ON l.u = r.reached)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(reached) AS component_id,
       s.doc_id = min(reached) AS kept
FROM s JOIN r USING (doc_id) GROUP BY s.doc_id, g
"""
