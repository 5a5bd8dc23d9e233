"""History with stored flags, expired by rewriting the touched folders only.

One folder per scope value (month)::

    <path>/data/<scope>=<value>/    rows with valid_from, valid_to, is_current
    <path>/pending/                 a rewrite that has been decided

An expiry reads the scopes it touches (partition pruning), writes their new
rows aside and renames them to ``pending``; from then on the rewrite is
decided.  Then each folder of ``pending`` takes the place of the one in
``data`` by a rename: rows are written once.  No other folder is read or
written.

A driver that is lost in between leaves ``pending`` with the folders that have
not been moved.  Readers take these scopes from there and the moved ones from
``data``, so they see the whole rewrite, whatever it has replaced so far; the
next writer moves the rest and goes on.
Expiring a scope and appending its new rows is one rewrite: no reader sees a
scope without current rows.

One writer at a time (a load owns its table); ``HistoryStore`` is the form
whose loads never rewrite.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.operators.history import (CURRENT, VALID_FROM, VALID_TO, append_merge_schema, expire_scope, reduce_or,
                                        stamp_history)
from tollgate.sources import files


class ScopedTable:
    def __init__(self, spark: SparkSession, path: str, scope_cols: list[str], schema: T.StructType):
        """``schema`` are the table's columns with the three history columns;
        ``scope_cols`` are plain columns of it."""
        missing = [c for c in (*scope_cols, VALID_FROM, VALID_TO, CURRENT) if c not in schema.names]
        if missing or not scope_cols:
            raise ValueError(f"the schema lacks {missing or 'a scope'}")
        self.spark, self.path, self.scope_cols = spark, path.rstrip("/"), list(scope_cols)
        # partition columns are read last
        self.schema = T.StructType([f for f in schema if f.name not in scope_cols] + [schema[c] for c in scope_cols])

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    @property
    def _pending(self) -> str:
        return f"{self.path}/pending"

    # -------------------------------------------------------------- read ---

    def _scan(self, folder: str) -> DataFrame:
        if not files.exists(self.spark, folder):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(folder)

    def _keys(self, rows: DataFrame) -> list:
        """Distinct scope keys: one per folder of the table at most, or per
        folder that a write is about to make."""
        return rows.select(*self.scope_cols).distinct().collect()

    def _within(self, keys: list) -> Column:
        """The rows of these scopes, as a filter that prunes folders."""
        if not keys:
            return F.lit(False)
        if len(self.scope_cols) > 1:
            return reduce_or([_all([F.col(c).eqNullSafe(F.lit(k[c]).cast(self.schema[c].dataType)) for c in self.scope_cols])
                              for k in keys])
        (c,) = self.scope_cols
        known = F.col(c).isin([k[c] for k in keys if k[c] is not None])
        return F.coalesce(known, F.lit(False)) | F.col(c).isNull() if any(k[c] is None for k in keys) else known

    def read(self) -> DataFrame:
        """All rows; a decided rewrite is seen as a whole."""
        rows = self._scan(self._data)
        if not files.exists(self.spark, self._pending):
            return rows
        pending = self._scan(self._pending)
        return rows.filter(~F.coalesce(self._within(self._keys(pending)), F.lit(False))).unionByName(pending)

    # ------------------------------------------------------------- write ---

    def recover(self) -> None:
        """Finish a rewrite that an earlier writer has decided."""
        if files.exists(self.spark, self._pending):
            self._replace()

    def _folders(self, root: str, below: str = "") -> list[str]:
        """The scope folders below ``root``: one level per scope column."""
        depth = below.count("/")
        if depth == len(self.scope_cols):
            return [below]
        prefix = f"{self.scope_cols[depth]}="
        return [leaf for n in files.entries(self.spark, root + below) if n.startswith(prefix)
                for leaf in self._folders(root, f"{below}/{n}")]

    def _replace(self) -> None:
        """A folder leaves ``pending`` only when it stands in ``data``."""
        for folder in self._folders(self._pending):
            files.remove(self.spark, self._data + folder)
            files.rename(self.spark, self._pending + folder, self._data + folder)
        files.remove(self.spark, self._pending)

    def _clustered(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.names).hint("rebalance", *self.scope_cols)

    def _rewrite(self, rows: DataFrame) -> None:
        """``rows`` become all rows of their scopes."""
        aside = f"{self.path}/aside-{uuid.uuid4().hex}"
        try:
            self._clustered(rows).write.partitionBy(*self.scope_cols).parquet(aside)
            files.rename(self.spark, aside, self._pending)
        except BaseException:
            files.remove(self.spark, aside)
            raise
        self._replace()

    def expire(self, scope: DataFrame, as_of) -> None:
        """Current rows of the listed scopes expire; other folders stay as they
        are.  Scopes that the table does not have are no work, NULL keys never
        match."""
        self.recover()
        keys = [k for k in self._keys(scope) if all(k[c] is not None for c in self.scope_cols)]
        touched = self._scan(self._data).filter(self._within(keys))
        listed = self.spark.createDataFrame([tuple(k) for k in keys], T.StructType([self.schema[c] for c in self.scope_cols]))
        if keys:
            self._rewrite(expire_scope(touched, listed, self.scope_cols, as_of, listed=True))

    def reload(self, incoming: DataFrame, as_of) -> None:
        """Current rows of the incoming rows' scopes expire and the incoming
        rows are appended with their stamps, in one rewrite.  Rows with a NULL
        key expire nothing."""
        self.recover()
        keys = self._keys(incoming)
        if not keys:
            return
        touched = self._scan(self._data).filter(self._within(keys))
        listed = self.spark.createDataFrame([tuple(k) for k in keys], T.StructType([self.schema[c] for c in self.scope_cols]))
        self._rewrite(append_merge_schema(expire_scope(touched, listed, self.scope_cols, as_of, listed=True),
                                          stamp_history(incoming, as_of)))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out &= c
    return out
