"""Exact deduplication by Grace hash partitioning.

Records are partitioned by a hash of their normalised text.  Within a bucket
an open-addressing table compares complete contents.  A bucket whose distinct
contents outgrow the table's memory bound writes the rest to an overflow table
in the shared folder, which is partitioned again by other hash bits, until
every bucket has fitted.  Equal contents always share a bucket, so the groups
are exact.

Skew: every input task first groups its own copies with the same kind of
table, so a group of copies, however large, ships at most one text per table
filled by a task.  Members follow by row number only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.staging import materialise

TABLE_BYTES = 64 << 20
WHITESPACE_RUN = r"[\x20\x09-\x0D]+"


class ContentTable:
    """Open addressing with linear probing; a slot matches only when the
    complete content is equal."""

    def __init__(self, limit: int):
        self.limit, self.bytes = limit, 0
        self.slots: list[tuple[int, bytes, int] | None] = [None] * 1024
        self.used = 0

    def group(self, h: int, content: bytes, row: int) -> int | None:
        """Row of the first record with this content; None when the content
        is new and the table is full."""
        mask = len(self.slots) - 1
        i = h & mask
        while (slot := self.slots[i]) is not None:
            if slot[0] == h and slot[1] == content:
                return slot[2]
            i = (i + 1) & mask
        if self.used and self.bytes + len(content) > self.limit:
            return None
        self.slots[i] = (h, content, row)
        self.used += 1
        self.bytes += len(content) + 120  # the entry's own size in Python
        if 2 * self.used > len(self.slots):
            self._grow()
        return row

    def _grow(self) -> None:
        old = [s for s in self.slots if s is not None]
        self.slots = [None] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for s in old:
            i = s[0] & mask
            while self.slots[i] is not None:
                i = (i + 1) & mask
            self.slots[i] = s


def _local_copies(limit: int):
    """Per input task: each row's local representative; only representatives
    keep their text.  A full table is replaced by an empty one, which merely
    leaves more for the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable(limit)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, hashes = batch.column("row").to_pylist(), batch.column("h").to_pylist()
            texts = batch.column("body").cast(pa.binary()).to_pylist()
            reps = []
            for row, h, text in zip(rows, hashes, texts, strict=True):
                rep = table.group(h, text, row)
                if rep is None:
                    table = ContentTable(limit)
                    rep = table.group(h, text, row)
                reps.append(rep)
            first = pa.array([a == b for a, b in zip(rows, reps, strict=True)])
            body = pa.compute.if_else(first, batch.column("body"), pa.scalar(None, batch.column("body").type))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("sha"), pa.array(reps, pa.int64()),
                 batch.column("h"), body], names=["row", "id", "sha", "rep", "h", "body"])

    return run


def _bucket_groups(limit: int):
    """Per bucket: the group of each representative, or its record again (with
    no group) when the bucket's table is full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable(limit)
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [table.group(h, text, rep) for rep, h, text in zip(
                batch.column("rep").to_pylist(), batch.column("h").to_pylist(),
                batch.column("body").cast(pa.binary()).to_pylist(), strict=True)]
            group = pa.array(found, pa.int64())
            body = pa.compute.if_else(group.is_null(), batch.column("body"),
                                      pa.scalar(None, batch.column("body").type))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), group, batch.column("h"), body],
                                             names=["rep", "group", "h", "body"])

    return run


def normalised(text) -> F.Column:
    """Null as empty, every run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITESPACE_RUN, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                table_bytes: int = TABLE_BYTES, buckets: int | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    - Null and empty texts are one group of empty contents.
    - A null id comes after all others; keep_id is null only if every id of
      the group is null.
    - Of repeated rows (same id and text) exactly one is kept.
    - An empty table gives an empty result.  Other columns of ``docs`` are
      neither read nor returned, so their names cannot clash.
    """
    n = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), normalised(F.col(text_col)).alias("body"))
            .select(F.monotonically_increasing_id().alias("row"), "id", "body",
                    F.unhex(F.sha2("body", 256)).alias("sha"), F.xxhash64("body").alias("h")))
    local = materialise(rows.mapInArrow(
        _local_copies(table_bytes // 2), "row long, id long, sha binary, rep long, h long, body string"), "copies")

    todo, done, level = local.filter("body is not null").select("rep", "h", "body"), None, 0
    while todo is not None:
        # Other hash bits at every level, so a bucket's overflow spreads out.
        dealt = todo.repartition(n, F.xxhash64(F.col("h"), F.lit(level)))
        out = materialise(dealt.mapInArrow(
            _bucket_groups(table_bytes), "rep long, group long, h long, body string"), f"bucket{level}")
        part = out.filter("group is not null").select("rep", "group")
        done = part if done is None else done.unionByName(part)
        over = out.filter("group is null").select("rep", "h", "body")
        todo, level = (None if over.isEmpty() else over), level + 1

    order = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    reps = local.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("best")).join(done, "rep")
    groups = reps.groupBy("group").agg(F.sum("n").alias("group_size"), F.min("best").alias("best"))
    resolved = reps.select("rep", "group").join(groups, "group").select("rep", "group_size", "best")
    return (local.select("row", "id", "sha", "rep").join(resolved, "rep")
            .select(F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(body) AS text_sha256
FROM t
"""
