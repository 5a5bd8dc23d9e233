"""End-to-end loads: raw -> bronze, bronze -> silver (annotate or reject).

raw -> bronze
    one scan of all selected extracts (file name as batch key)
    -> one range sort for dense row ids, staged once in the shared folder
       with one evaluation of every physical rule: each row's failures; lines
       with the wrong number of fields have none and are set apart as
       ``malformed``
    -> one summary per extract from the failure columns: gate, counts
    -> accepted rows to bronze (with the table's audit defaults), rejected
       rows (with reasons) to bronze-rejected, per-value error log, run
       metrics and END event.

bronze -> silver
    current bronze rows -> month key -> newest file per month and the rows
    without a month (one aggregate; broadcast join of at most one row per
    month) -> referential checks, once, as miss flags -> the range sort for new
    row ids, staged once -> silver history (scope: month) [+ rejected
    history], error log, metrics.

The staged rows are the only copy besides the outputs; each output is a
projection of them, and they are removed when the load ends.  Every output
belongs to its run and replaces that run's earlier output as a whole, so a
retry leaves nothing stale.  Readers see a run when it has ended, all of its
tables at once: a load that breaks off leaves the tables as they were.  Nothing
row-level passes through the driver: it sees rule rows, the extract listing,
one row per extract or month, and one per sorted partition.

``load_by_process`` starts from names only: the control tables give the
process, its parameters, its active rules and its masters; ``start_runs`` gives
runs their ids.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions import rules as R
from tollgate.functions.rules import Rule
from tollgate.operators import quality as Q
from tollgate.operators import references as X
from tollgate.operators import runs as K
from tollgate.operators import versions as V
from tollgate.operators.history import CURRENT, HISTORY_ZONE, RUN
from tollgate.operators.rowids import partitions_for, prefixed, read_numbered, stage_ordered
from tollgate.sources import delimited as DL
from tollgate.sources import files
from tollgate.sources import schemas as S
from tollgate.sources.history_store import HistoryStore
from tollgate.staging import staged_path, unstage

MALFORMED = "malformed"

# Audit columns of a bronze table and their defaults.
AUDIT_DEFAULTS = T.StructType([
    S.field("sys_status_code", T.StringType(), False, "Row status", default="'A'"),
    S.field("sys_created_by_name", T.StringType(), False, "Created by", default="'MANUAL INSERT'"),
])


@dataclass
class Warehouse:
    """Folder layout of one installation (shared storage).  ``bronze_scope``
    are the columns by which a bronze run supersedes earlier ones (none: the
    whole table)."""
    root: str
    bronze_scope: list[str] = field(default_factory=list)

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def _store(self, spark, layer: str, table: str, scope: list[str] | None = None) -> HistoryStore:
        return HistoryStore(spark, self.path(layer, table), scope, lambda: ended_runs(spark, self))

    def bronze(self, spark, table) -> HistoryStore:
        return self._store(spark, "bronze", table, self.bronze_scope)

    def bronze_rejected(self, spark, table) -> HistoryStore:
        return self._store(spark, "bronze_rejected", table, self.bronze_scope)

    def silver(self, spark, table) -> HistoryStore:
        return self._store(spark, "silver", table, [V.MONTH])

    def silver_rejected(self, spark, table) -> HistoryStore:
        return self._store(spark, "silver_rejected", table)

    @property
    def error_log(self) -> str:
        return self.path("control", "object_validation_error")

    @property
    def run_events(self) -> str:
        return self.path("control", "run_events")

    @property
    def loaded_files(self) -> str:
        return self.path("control", "loaded_files")

    @property
    def run_ids(self) -> str:
        return self.path("control", "run_ids")


@dataclass
class RunInfo:
    run_id: int
    process_id: int
    as_of: str | dt.datetime = field(default_factory=lambda: _now_text())


def _now_text(zone: str = HISTORY_ZONE) -> str:
    from zoneinfo import ZoneInfo
    return dt.datetime.now(ZoneInfo(zone)).replace(tzinfo=None).isoformat(sep=" ")


# -------------------------------------------------------------- control ---

ERROR_LOG_SCHEMA = ("rule_id bigint, row_id string, error_value string, run_id bigint, object_name string")


def read_error_log(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return spark.read.schema(ERROR_LOG_SCHEMA).parquet(wh.error_log)


def read_run_events(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return spark.read.schema(K.EVENT_SCHEMA).option("recursiveFileLookup", "true").parquet(wh.run_events)


def ended_runs(spark: SparkSession, wh: Warehouse) -> set[int]:
    """Ids of the runs with an END event (one each, like the run folders that
    the driver lists)."""
    if not files.entries(spark, wh.run_events):
        return set()
    return {r["run_id"] for r in read_run_events(spark, wh).filter(F.col("event") == K.END).select("run_id").distinct().collect()}


def start_runs(spark: SparkSession, wh: Warehouse, process_ids: list[int], as_of=None) -> list[RunInfo]:
    """Runs with ids of their own, in the order of ``process_ids``.

    Ids go on from the largest that the ledger or a claim knows.  Each is
    claimed by creating its file exclusively, so two drivers that start runs at
    once never share one; the one that comes second takes the next."""
    known = [int(n) for n in (*files.entries(spark, wh.run_ids), *files.entries(spark, wh.run_events)) if n.isdigit()]
    stamp, runs, number = as_of or _now_text(), [], max(known, default=0)
    for process_id in process_ids:
        number += 1
        while not files.create_exclusive(spark, f"{wh.run_ids}/{number}"):
            number += 1
        runs.append(RunInfo(number, process_id, stamp))
    return runs


def loaded_files(spark: SparkSession, wh: Warehouse, table: str) -> DataFrame:
    """file_name of every extract that an ended run has loaded into ``table``."""
    schema = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("object_name", T.StringType()),
                           T.StructField(RUN, T.LongType())])
    if not files.entries(spark, wh.loaded_files):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(wh.loaded_files).filter(
        (F.col("object_name") == table) & F.col(RUN).isin(sorted(ended_runs(spark, wh))))


def _replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def _write_error_log(wh: Warehouse, table: str, run: RunInfo, log: DataFrame) -> None:
    """The log of one table's load in one run, replaced as a whole."""
    _replace(log.drop("run_id"), f"{wh.error_log}/run_id={run.run_id}/object_name={table}")


def _events_path(wh: Warehouse, run: RunInfo) -> str:
    # run_id is a column of the events: the folder's name carries no partition
    return f"{wh.run_events}/{run.run_id}"


def _start(spark: SparkSession, wh: Warehouse, run: RunInfo) -> DataFrame:
    """The run's only event until it ends: a run that breaks off shows as failed."""
    start = K.event(spark, run.run_id, run.process_id, 1, K.START, ts=dt.datetime.fromisoformat(str(run.as_of)))
    _replace(start.coalesce(1), _events_path(wh, run))
    return start


def _end(spark: SparkSession, wh: Warehouse, run: RunInfo, start: DataFrame, counts: dict[str, int]) -> None:
    """All events of the run, written at once: a retried run has them once."""
    ts = dt.datetime.fromisoformat(str(run.as_of))
    events = start
    for seq, (name, value) in enumerate(counts.items(), 10):
        events = events.unionByName(K.event(spark, run.run_id, run.process_id, seq, K.SET, name, value, ts))
    events = events.unionByName(K.event(spark, run.run_id, run.process_id, 99, K.END, ts=ts))
    _replace(events.coalesce(1), _events_path(wh, run))


def _parts(spark: SparkSession, n_bytes: int) -> int:
    return partitions_for(n_bytes, spark.sparkContext.defaultParallelism)


# --------------------------------------------------------------- bronze ---

def bronze_load(spark: SparkSession, wh: Warehouse, table: str, landing: str, names: list[str],
                spec: DL.ReaderSpec, rules: list[Rule], run: RunInfo,
                apply_mask: bool = False, skip_loaded: bool = False,
                only: DataFrame | None = None) -> dict[str, int]:
    """raw -> bronze for every matching extract of ``landing`` (of those that
    ``only`` names, if given).  With ``skip_loaded`` extracts that an earlier
    run has loaded are not read again."""
    loaded = loaded_files(spark, wh, table).filter(F.col(RUN) != run.run_id) if skip_loaded else None
    raw = DL.ingest(spark, landing, names, spec, apply_mask=apply_mask, flag_malformed=True, loaded=loaded,
                    only=only)
    return load_bronze_frame(spark, wh, table, raw, names, rules, run, delivery=landing,
                             n_bytes=DL.folder_bytes(spark, landing))


def load_bronze_frame(spark: SparkSession, wh: Warehouse, table: str, raw: DataFrame,
                      names: list[str], rules: list[Rule], run: RunInfo, delivery: str = "",
                      n_bytes: int = 0) -> dict[str, int]:
    """raw -> bronze for an already scanned frame carrying ``file_name``."""
    wh.bronze(spark, table).claim(run.run_id, f"{run.as_of}|{delivery}")
    start = _start(spark, wh, run)
    if DL.CORRUPT not in raw.columns:
        raw = raw.withColumn(DL.CORRUPT, F.lit(None).cast("string"))
    bad = F.col(DL.CORRUPT).isNotNull()
    # A malformed line's values stand for nothing: no rule sees them.
    failures = Q.failure_columns(raw, rules, skip=bad)
    path = staged_path(spark, "load")
    try:
        schema = stage_ordered(raw, ["file_name", *names, DL.CORRUPT], path, _parts(spark, n_bytes), failures)
        numbered = read_numbered(spark, path, schema, "row_id").withColumn("row_id", prefixed(run.run_id, F.col("row_id")))
        staged, summary = _gated(numbered, rules, bad)
        is_ok = F.col(Q.REASONS) == ""
        columns = [*raw.columns, "row_id"]
        accepted = staged.filter(is_ok).select(*[c for c in columns if c != DL.CORRUPT])
        audited = T.StructType([*accepted.schema.fields, *AUDIT_DEFAULTS.fields])
        wh.bronze(spark, table).append(S.apply_defaults(accepted, audited), run.run_id, run.as_of, delivery)
        wh.bronze_rejected(spark, table).append(
            staged.filter(~is_ok).select(*columns, Q.REASONS), run.run_id, run.as_of, delivery)
        _write_error_log(wh, table, run, Q.log_failures(staged, run.run_id, "row_id"))
        loaded = spark.createDataFrame([(r["file_name"],) for r in summary], "file_name string")
        _replace(loaded.coalesce(1), f"{wh.loaded_files}/object_name={table}/{RUN}={run.run_id}")
        counts = {"source_record_count": sum(r["source_rows"] for r in summary),
                  "target_record_count": sum(r["passing_rows"] for r in summary if r[Q.GATE] == "")}
        _end(spark, wh, run, start, counts)
    finally:
        unstage(spark, path)
    return {"source": counts["source_record_count"], "accepted": counts["target_record_count"]}


def _gated(numbered: DataFrame, rules: list[Rule], bad: Column) -> tuple[DataFrame, list[Row]]:
    """The staged rows with gate decision and reasons, and the summary of each
    extract: the driver has the extract listing, so it can have these."""
    spark = numbered.sparkSession
    summary = Q.batch_summary(numbered, rules, Q.FILE, ~bad).collect()
    gates = spark.createDataFrame([(r[Q.FILE], r[Q.GATE]) for r in summary], f"_tg_f string, {Q.GATE} string")
    gated = numbered.join(F.broadcast(gates), F.col(Q.FILE) == F.col("_tg_f"), "left").drop("_tg_f")
    gated = gated.withColumn(Q.GATE, F.when(bad, F.lit("")).otherwise(F.coalesce(F.col(Q.GATE), F.lit(""))))
    reason = F.when(bad, F.lit(MALFORMED)).when(F.col(Q.GATE) != "", F.col(Q.GATE)).otherwise(Q.fail_reasons(Q.ROW_FAILS))
    return gated.withColumn(Q.REASONS, reason), summary


# --------------------------------------------------------------- silver ---

_NOT_BUSINESS = {"row_id", "valid_from", "valid_to", CURRENT, RUN, *AUDIT_DEFAULTS.fieldNames()}


def bronze_months(spark: SparkSession, wh: Warehouse, table: str) -> DataFrame:
    """Current bronze business columns with the month key."""
    bronze = wh.bronze(spark, table).current()
    return V.with_month(bronze.select(*[c for c in bronze.columns if c not in _NOT_BUSINESS]))


def silver_input(spark: SparkSession, wh: Warehouse, table: str) -> tuple[DataFrame, int]:
    """Current bronze rows of the newest file per month, and the number of
    rows left out for want of a month."""
    months = bronze_months(spark, wh, table)
    newest, dropped = V.newest_files(months)
    return months.join(F.broadcast(newest), [V.FILE, V.MONTH]).select(*months.columns), dropped


_NULLS = "_tg_nulls"


def _silver(spark: SparkSession, wh: Warehouse, table: str, rules: list[Rule], resolve: X.MasterResolver, run: RunInfo,
            write) -> dict[str, int]:
    """Claim, read, check once, stage once in row-id order, write the outputs,
    the error log and the run's end.  ``write`` gets the staged rows with their
    miss flags, the columns and the applied rules, and returns the number of
    rows that silver has got."""
    wh.silver(spark, table).claim(run.run_id, f"{run.as_of}|")
    start = _start(spark, wh, run)
    source, dropped = silver_input(spark, wh, table)
    columns = source.columns
    # The checks fill NULLs, ids are ordered by the values as they came.
    text = [f.name for f in source.schema if isinstance(f.dataType, T.StringType)]
    marked = source.withColumn(_NULLS, F.array(*[F.col(c).isNull() for c in text]))
    flagged, applied = X.flagged_rows(marked, rules, resolve)
    order = [F.when(~F.col(_NULLS)[text.index(c)], F.col(c)) if c in text else F.col(c) for c in columns]
    path = staged_path(spark, "load")
    try:
        n_bytes = DL.folder_bytes(spark, wh.bronze(spark, table)._part("data"))
        schema = stage_ordered(flagged, order, path, _parts(spark, n_bytes))
        staged = read_numbered(spark, path, schema, "row_id").withColumn("row_id", prefixed(run.run_id, F.col("row_id")))
        size = staged.agg(F.count(F.lit(1)).alias("n"), F.count_if(~X.missed_any(applied)).alias("hits")).first()
        accepted = write(staged, [*columns, "row_id"], applied, size)
        _write_error_log(wh, table, run, X.log_misses(staged, applied, run.run_id))
        counts = {"source_record_count": size["n"], "target_record_count": accepted, "null_month_rows": dropped}
        _end(spark, wh, run, start, counts)
    finally:
        unstage(spark, path)
    return {"source": counts["source_record_count"], "accepted": counts["target_record_count"]}


def silver_load(spark: SparkSession, wh: Warehouse, table: str, rules: list[Rule],
                resolve: X.MasterResolver, run: RunInfo) -> dict[str, int]:
    """bronze -> silver: every row kept, failed lookups marked TBD."""
    def write(staged: DataFrame, columns: list[str], applied: list[Rule], size: Row) -> int:
        wh.silver(spark, table).append(X.annotated_from(staged, columns, applied), run.run_id, run.as_of)
        return size["n"]

    return _silver(spark, wh, table, rules, resolve, run, write)


def silver_load_with_rejects(spark: SparkSession, wh: Warehouse, table: str, rules: list[Rule],
                             resolve: X.MasterResolver, run: RunInfo) -> dict[str, int]:
    """bronze -> silver where rows missing a lookup go to silver-rejected."""
    def write(staged: DataFrame, columns: list[str], applied: list[Rule], size: Row) -> int:
        missed = X.missed_any(applied)
        wh.silver(spark, table).append(staged.filter(~missed).select(*columns), run.run_id, run.as_of)
        wh.silver_rejected(spark, table).append(
            X.judged_from(staged.filter(missed), columns, applied), run.run_id, run.as_of)
        return size["hits"]

    return _silver(spark, wh, table, rules, resolve, run, write)


# ------------------------------------------------------------ by process ---

@dataclass
class ControlTables:
    """What the loads of an installation are configured by."""
    parameters: DataFrame
    rules: DataFrame
    masters: X.MasterResolver


def load_by_process(spark: SparkSession, wh: Warehouse, control: ControlTables, name: str, step: str, system: str,
                    run_id: int, as_of, table: str, landing: str | None = None,
                    columns: list[str] | None = None) -> dict[str, int]:
    """Run the load that a process names: its one active parameter row gives
    the reader and the schema, its active rules the checks.  The step decides
    the layer: ``raw to bronze`` reads ``landing``, ``bronze to silver`` the
    bronze table."""
    row = K.process_parameters(control.parameters, name, step, system).first()
    run = RunInfo(run_id, row["process_id"], as_of)
    runs = spark.createDataFrame([(run_id, row["process_id"])], "run_id bigint, process_id bigint")
    kind = R.PHYSICAL if step.lower() == "raw to bronze" else R.BUSINESS
    rules = R.collect_rules(R.active_rules(runs, control.rules, run_id, kind))
    if kind == R.PHYSICAL:
        if landing is None:
            raise ValueError("a raw to bronze load needs a landing folder")
        spec = DL.ReaderSpec.from_row(row)
        names = columns or S.get_schema(row["schema_name"]).fieldNames()
        return bronze_load(spark, wh, table, landing, names, spec, rules, run, apply_mask=True, skip_loaded=True)
    return silver_load(spark, wh, table, rules, control.masters, run)
