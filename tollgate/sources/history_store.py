"""Path-backed, append-only history tables.

Parquet has no UPDATE or MERGE, and rewriting a whole history table on every
load does not scale.  A load only adds files, and replaces nothing but its own
run::

    <path>/data/run_id=<n>/[<scope>=<value>/]  the run's rows, with valid_from
    <path>/scopes/run_id=<n>/                  the scope keys the run wrote
    <path>/runs/run_id=<n>                     whose run it is
    <path>/layouts/<key>                       columns as some runs wrote them
    <path>/written/run_id=<n>.<key>            the layout of a run
    <path>/spec/version=<n>                    the table's columns

``valid_to``/``is_current`` follow from the scopes table (scopes x runs rows,
never a scan of the data): a version expires when a newer run has written the
same scope, with no file of the older run touched.  ``current()`` reads no
partition of a run before the oldest that still has a current scope.

A run is visible when its layout is named in ``written``, which one small file
does when all else is there.  Writes replace the run's folders as a whole, empty results included, so a retried
load leaves nothing of its first attempt, whatever the new verdicts.  A run id
that another delivery has used is refused.

A column may change to a wider type (``widening``).  Files are never
rewritten for it: a read takes each run by the columns it was written with and
casts them to the newest.  Runs whose files agree are one scan, so there are as
many scans as incompatible layouts, not runs.  A change that no type holds is
refused before anything is written.  The columns come from the stored specs: a
read never merges footers, and a table without any row can be read.

Rows are written clustered by scope (``REBALANCE``): small scopes share a
task, a hot scope is split by bytes, and each task holds few scopes.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.operators.history import (CURRENT, RUN, VALID_FROM, VALID_TO, as_timestamp,
                                        newest_runs, next_runs, with_validity)
from tollgate.sources import files
from tollgate.sources.widening import TypeChange, as_type, same_type, widened

__all__ = ["HistoryStore", "RunInUse", "TypeChange"]


class RunInUse(ValueError):
    """The run id belongs to another delivery."""


class HistoryStore:
    """``ended`` gives the run ids that have ended as a whole, where a ledger
    knows them: rows of other runs are not seen."""

    def __init__(self, spark: SparkSession, path: str, scope_cols: list[str] | None = None,
                 ended: Callable[[], set[int]] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.scope_cols = list(scope_cols or [])
        self.ended = ended

    # ------------------------------------------------------------- paths ---

    def _part(self, kind: str) -> str:
        return f"{self.path}/{kind}"

    def _run_part(self, kind: str, run_id: int) -> str:
        return f"{self._part(kind)}/{RUN}={run_id}"

    def _entries(self, folder: str) -> list[str]:
        return files.entries(self.spark, folder)

    # ------------------------------------------------------------ schema ---

    def schema(self) -> T.StructType | None:
        """Business columns of the table, from the newest spec; None before
        the first load."""
        version = self._spec_version()
        return self._spec_at(f"{self._part('spec')}/version={version}") if version else None

    def _spec_version(self) -> int:
        return max((int(n.split("=")[1]) for n in self._entries(self._part("spec")) if n.startswith("version=")), default=0)

    def _spec_at(self, path: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(files.read_text(self.spark, path)))

    def exists(self) -> bool:
        return self.schema() is not None

    def _visible(self) -> set[int]:
        """Runs that have written all they write, of a load that has ended."""
        written = set(self._written())
        return written if self.ended is None else written & self.ended()

    def _only(self, rows: DataFrame, kind: str, runs: set[int]) -> DataFrame:
        """The partitions of these runs, without a filter where they are all."""
        there = {int(n.split("=")[1]) for n in self._entries(self._part(kind)) if n.startswith(f"{RUN}=")}
        if there <= runs:
            return rows
        return rows.filter(F.col(RUN).isin(sorted(runs)) if runs else F.lit(False))

    def _layouts(self, visible: set[int]) -> list[tuple[set[int], T.StructType]]:
        """Visible runs by the columns they were written with: runs whose
        common columns have equal types are one layout."""
        if not visible:
            return []
        by_key: dict[str, set[int]] = {}
        for run, key in sorted(self._written().items()):
            if run in visible:
                by_key.setdefault(key, set()).add(run)
        layouts: list[tuple[set[int], dict[str, T.StructField]]] = []
        for key, runs in by_key.items():
            fields = {f.name: f for f in self._spec_at(f"{self._part('layouts')}/{key}")}
            for held, known in layouts:
                if all(same_type(f.dataType, known[n].dataType) for n, f in fields.items() if n in known):
                    held.update(runs)
                    known.update(fields)
                    break
            else:
                layouts.append((runs, fields))
        return [(runs, T.StructType(list(known.values()))) for runs, known in layouts]

    def _written(self) -> dict[int, str]:
        """Layout by run, from the names alone."""
        names = (n.removeprefix(f"{RUN}=").split(".") for n in self._entries(self._part("written")) if n.startswith(f"{RUN}="))
        return {int(run): key for run, key in names}

    # ------------------------------------------------------------- write ---

    def append(self, rows: DataFrame, run_id: int, as_of, delivery: str = "") -> None:
        """Write one run's rows; ``delivery`` names what the run loads, so that
        a retry can be told from another load with the same run id.

        Columns that the table has in a wider type are written in it; a wider
        incoming type widens the table (``TypeChange`` where neither holds)."""
        drop = [c for c in (VALID_TO, CURRENT, RUN, VALID_FROM) if c in rows.columns]
        business = rows.drop(*drop)
        known = self.schema()
        wide = widened(known, business.schema, self.scope_cols)  # refuses before anything is written
        self.claim(run_id, f"{as_of}|{delivery}")
        self._hide(run_id)  # a retried run is not visible until it ends
        written = T.StructType([T.StructField(f.name, wide[f.name].dataType) for f in business.schema])
        out = business.select(*[as_type(F.col(f"`{f.name}`"), f.dataType, written[f.name].dataType).alias(f.name)
                                for f in business.schema], as_timestamp(as_of).alias(VALID_FROM))
        if known is None or wide != known:
            files.write_text(self.spark, f"{self._part('spec')}/version={self._spec_version() + 1}", wide.json())
        scopes = self._write(out, run_id).withColumn(VALID_FROM, as_timestamp(as_of))
        scopes.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self._run_part("scopes", run_id))
        self._show(run_id, written)

    def _hide(self, run_id: int) -> None:
        old = self._written().get(run_id)
        if old:
            files.remove(self.spark, f"{self._run_part('written', run_id)}.{old}")

    def _show(self, run_id: int, written: T.StructType) -> None:
        key = hashlib.sha256(written.json().encode()).hexdigest()[:32]
        files.write_text(self.spark, f"{self._part('layouts')}/{key}", written.json())
        files.write_text(self.spark, f"{self._run_part('written', run_id)}.{key}")

    def _write(self, out: DataFrame, run_id: int) -> DataFrame:
        """Write the run's rows and return its scopes, seen by the same job."""
        seen = Observation()
        if self.scope_cols:
            out = out.hint("rebalance", *self.scope_cols)
            keys = F.collect_set(F.struct(*self.scope_cols))  # one entry per folder that the write makes
        else:
            keys = F.count(F.lit(1))
        writer = out.observe(seen, keys.alias("scopes")).write.mode("overwrite").option("partitionOverwriteMode", "static")
        if self.scope_cols:
            writer = writer.partitionBy(*self.scope_cols)
        writer.parquet(self._run_part("data", run_id))
        found = seen.get.get("scopes")
        schema = T.StructType([*[T.StructField(c, out.schema[c].dataType) for c in self.scope_cols]])
        if self.scope_cols:
            keys = self.spark.createDataFrame([tuple(k) for k in found or []], schema)
        else:
            keys = self.spark.range(1 if found else 0).select()
        return keys

    def claim(self, run_id: int, owner: str) -> None:
        """Take the run id for ``owner``; one of two who try at once gets it."""
        path = self._run_part("runs", run_id)
        if files.create_exclusive(self.spark, path, owner):
            return
        holder = files.read_text(self.spark, path)
        if holder != owner:
            raise RunInUse(f"run {run_id} of {self.path} belongs to {holder!r}, not to {owner!r}")

    # -------------------------------------------------------------- read ---

    def raw(self) -> DataFrame:
        """All versions as written, in the newest types: business columns,
        valid_from, run_id."""
        known = self.schema()
        if known is None:
            raise LookupError(f"no load has written {self.path}")
        whole = T.StructType([*known.fields, T.StructField(VALID_FROM, T.TimestampNTZType()), T.StructField(RUN, T.LongType())])
        layouts = self._layouts(self._visible())
        if not layouts:
            return self.spark.createDataFrame([], whole)
        parts = [self._scan(runs, layout, known, whole) for runs, layout in layouts]
        return reduce(DataFrame.unionByName, parts)

    def _scan(self, runs: set[int], layout: T.StructType, known: T.StructType, whole: T.StructType) -> DataFrame:
        """The runs of one layout, cast to the table's types."""
        physical = T.StructType([layout[f.name] if f.name in layout.names else f for f in known.fields]
                                + whole.fields[-2:])
        rows = self._only(self.spark.read.schema(physical).parquet(self._part("data")), "data", runs)
        return rows.select(*[as_type(F.col(f"`{f.name}`"), physical[f.name].dataType, f.dataType).alias(f.name)
                              for f in whole.fields])

    def scopes(self) -> DataFrame:
        """(scope columns, valid_from, run_id) of every run that wrote rows."""
        known = self.schema() or T.StructType()
        whole = T.StructType([*[known[c] for c in self.scope_cols if c in known.fieldNames()],
                              T.StructField(VALID_FROM, T.TimestampNTZType()), T.StructField(RUN, T.LongType())])
        if not self._entries(self._part("scopes")):
            return self.spark.createDataFrame([], whole)
        return self._only(self.spark.read.schema(whole).parquet(self._part("scopes")), "scopes", self._visible())

    def read(self) -> DataFrame:
        """All versions with derived valid_to / is_current."""
        return with_validity(self.raw(), next_runs(self.scopes(), self.scope_cols), self.scope_cols)

    def current(self) -> DataFrame:
        """The current versions only: partitions of expired runs are not read."""
        if not self.scope_cols:
            newest = self.scopes().agg(F.max(RUN)).first()[0]
            kept = self.raw().filter(F.col(RUN) == (-1 if newest is None else newest))
            return kept.withColumn(VALID_TO, F.lit(None).cast("timestamp_ntz")).withColumn(CURRENT, F.lit(True))
        alive = newest_runs(self.scopes(), self.scope_cols)
        oldest = alive.agg(F.min("_tg_run")).first()[0]  # from the scopes table alone
        kept = self.raw().filter(F.col(RUN) >= (0 if oldest is None else oldest))
        return with_validity(kept, alive, self.scope_cols, how="inner")
