"""Run ledger as an append-only event log with derived state.

Instead of UPDATE statements against a run table (which race across
concurrent runs and need a transactional table format), every change is an
appended event row:

    run_id, process_id, seq, event (START | SET | END), attr, value, event_ts

and the run table is *derived*:

* status: ``C`` once an END event exists, else ``E`` — a run that crashes
  before END is reported as failed without anyone writing ``E``;
* attribute values (counts, extract dates): latest SET per attribute,
  ``max_by(value, seq)``;
* last-run flag: the run with the greatest id of its process.

All derivations are grouped aggregates (partial aggregation before the
shuffle); per-process maxima are joined back without a hint, so Catalyst
and AQE choose the join from measured sizes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.operators.rowids import dense_row_numbers

START, SET, END = "START", "SET", "END"
COMPLETED, FAILED = "C", "E"
ACTIVE = "A"

EVENT_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType(), False),
    T.StructField("process_id", T.LongType(), False),
    T.StructField("seq", T.IntegerType(), False),
    T.StructField("event", T.StringType(), False),
    T.StructField("attr", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("event_ts", T.TimestampNTZType(), True),
])


def event(spark: SparkSession, run_id: int, process_id: int, seq: int, kind: str,
          attr: str | None = None, value=None, ts: dt.datetime | None = None) -> DataFrame:
    """One event row (to append to the ledger table)."""
    return spark.createDataFrame(
        [(run_id, process_id, seq, kind, attr, None if value is None else str(value),
          ts or dt.datetime.now())], EVENT_SCHEMA)


def process_lookup(processes: DataFrame, name: str, step: str, system: str,
                   use_ilike: bool = False) -> DataFrame:
    """Active process matching name/step/system case-insensitively; the
    lowest id wins (0 or 1 row).  ``use_ilike`` treats ``_``/``%`` in the
    arguments as wildcards."""
    def match(c, v):
        return F.col(c).ilike(v) if use_ilike else F.lower(F.col(c)) == F.lit(v.lower())
    return (processes.filter(match("process_name", name) & match("step_name", step)
                             & match("source_system", system) & (F.col("status") == ACTIVE))
                     .orderBy("process_id").limit(1))


def process_parameters(params: DataFrame, name: str, step: str, system: str | None = None) -> DataFrame:
    """The active parameter row of a process by name and step (and system).

    Exactly one row must match: none or several raise ``ParameterError`` with
    what was looked up."""
    cond = (F.lower(F.col("process_name")) == name.lower()) & (F.lower(F.col("step_name")) == step.lower())
    if system is not None:
        cond = cond & (F.lower(F.col("source_system")) == system.lower())
    found = params.filter(cond & (F.col("status") == ACTIVE))
    matches = found.count()
    if matches != 1:
        what = f"process {name!r}, step {step!r}" + (f", system {system!r}" if system is not None else "")
        raise ParameterError(f"{matches} active parameter rows for {what}; one is needed")
    return found


class ParameterError(LookupError):
    """A process does not have exactly one active parameter row."""


def run_starts(events: DataFrame) -> DataFrame:
    """run_id, process_id, start_ts of every started run."""
    return (events.filter(F.col("event") == START)
                  .groupBy("run_id", "process_id").agg(F.min("event_ts").alias("start_ts")))


def run_start_ids(events: DataFrame, starts: DataFrame, order_cols: list[str], id_col: str = "run_id") -> DataFrame:
    """The starts of a batch with new run ids: the largest id of the ledger (0
    for an empty one) plus a dense number in ``order_cols`` order."""
    numbered = dense_row_numbers(starts, order_cols, id_col)
    last = events.agg(F.coalesce(F.max("run_id"), F.lit(0))).scalar()
    return numbered.select(*[F.col(c) for c in starts.columns], (last + F.col(id_col)).alias(id_col))


def run_last(events: DataFrame) -> DataFrame:
    """Last run id per process."""
    return (events.filter(F.col("event") == START)
                  .groupBy("process_id").agg(F.max("run_id").alias("last_run_id")))


def run_last_flag(events: DataFrame) -> DataFrame:
    """Every run with ``last_flag`` 1 for its process's newest run, else 0."""
    last = run_last(events).withColumnRenamed("process_id", "_tg_p")
    runs = run_starts(events)
    j = runs.join(last, runs.process_id == F.col("_tg_p"), "inner")
    return j.select("run_id", "process_id", "start_ts",
                    F.when(F.col("run_id") == F.col("last_run_id"), 1).otherwise(0).alias("last_flag"))


def run_state(events: DataFrame, attrs: list[str] = ("source_count",)) -> DataFrame:
    """Per run: status (C when ended, else E), start/end time, latest value
    of each attribute."""
    aggs = [F.first("process_id").alias("process_id"),
            F.min(F.when(F.col("event") == START, F.col("event_ts"))).alias("start_ts"),
            F.max(F.when(F.col("event") == END, F.col("event_ts"))).alias("end_ts"),
            F.when(F.bool_or(F.col("event") == END), F.lit(COMPLETED))
             .otherwise(F.lit(FAILED)).alias("status")]
    for a in attrs:
        is_a = (F.col("event") == SET) & (F.col("attr") == a)
        aggs.append(F.max_by(F.when(is_a, F.col("value")), F.when(is_a, F.col("seq"))).alias(a))
    return events.groupBy("run_id").agg(*aggs)


def metric_events(counts: DataFrame, run_col: str, process_id: int, first_seq: int,
                  ts: dt.datetime | str) -> DataFrame:
    """SET events recording count columns of ``counts`` (one row per run)."""
    metrics = [c for c in counts.columns if c != run_col]
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("attr"),
                               F.col(m).cast("string").alias("value"))
                      for i, m in enumerate(metrics)])
    tsc = F.lit(ts if isinstance(ts, str) else ts.isoformat(sep=" ")).cast("timestamp_ntz")
    return (counts.select(F.col(run_col).cast("bigint").alias("run_id"), F.explode(pairs).alias("p"))
                  .select("run_id", F.lit(process_id).cast("bigint").alias("process_id"),
                          (F.lit(first_seq) + F.col("p.i")).cast("int").alias("seq"),
                          F.lit(SET).alias("event"), "p.attr", "p.value", tsc.alias("event_ts")))
