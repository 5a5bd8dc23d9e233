"""Validity history: stamping, expiry, append with schema merge, derived
validity.

Two equivalent formulations are offered:

* **Stored flags** (``expire_all``, ``expire_scope``, ``expire_and_append``):
  the history frame carries ``valid_to``/``is_current`` and a load rewrites
  the flags of the rows it supersedes.  Expressed as DataFrame transforms
  over the history; the scope side is one row per month.
* **Derived validity** (``derive_validity``): rows are only ever appended,
  each with its run id and ``valid_from``; ``valid_to`` is the ``valid_from``
  of the next run that touched the same scope.  The window runs over the
  distinct (scope, run) pairs only — months x runs, not rows — and is joined
  back without a hint.  This is the form the physical store uses (it keeps
  the pairs as a table): loads never rewrite old files.

Timestamps are ``TIMESTAMP_NTZ`` wall-clock values of the zone the caller
chooses (``functions.zones``), so results do not move with the session zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.operators.versions import reprocess_scope

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
CURRENT = "is_current"
FILE = "file_name"
RUN = "run_id"
# Fixed value: the zone history stamps are rendered in.
HISTORY_ZONE = "America/Sao_Paulo"


def as_timestamp(value: str | dt.datetime | Column) -> Column:
    """A literal or Column as TIMESTAMP_NTZ."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def stamp_history(df: DataFrame, as_of, file_name: str | Column | None = None) -> DataFrame:
    """valid_from = as_of, valid_to = NULL, is_current = TRUE (+ file name)."""
    cols = [F.col(c) for c in df.columns if c not in (VALID_FROM, VALID_TO, CURRENT)]
    extra = [as_timestamp(as_of).alias(VALID_FROM),
             F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
             F.lit(True).alias(CURRENT)]
    out = df.select(*cols, *extra)
    if file_name is not None:
        fc = F.lit(file_name) if isinstance(file_name, str) else file_name
        out = out.withColumn(FILE, fc)
    return out


def _expire_when(hit: Column, as_of) -> list[Column]:
    touched = hit & F.col(CURRENT)
    return [F.when(touched, as_timestamp(as_of)).otherwise(F.col(VALID_TO)).alias(VALID_TO),
            F.when(touched, F.lit(False)).otherwise(F.col(CURRENT)).alias(CURRENT)]


def expire_all(history: DataFrame, as_of) -> DataFrame:
    """Every current row -> is_current FALSE, valid_to = as_of."""
    others = [F.col(c) for c in history.columns if c not in (VALID_TO, CURRENT)]
    return history.select(*others, *_expire_when(F.lit(True), as_of)).select(*history.columns)


def expire_scope(history: DataFrame, scope: DataFrame, scope_cols: list[str], as_of, listed: bool = False) -> DataFrame:
    """Current rows whose scope key is listed in ``scope`` expire.  NULL
    scope keys never match.  ``scope`` is reduced to distinct keys; where they
    are few enough for the driver (``listed``) it takes them at once, by a job
    of its own, and broadcasts them: no row of the history is shuffled, and the
    broadcast waits for no other step."""
    keys = scope.select(*scope_cols)
    if listed:
        found = list(dict.fromkeys(map(tuple, keys.collect())))
        keys = F.broadcast(history.sparkSession.createDataFrame(found, keys.schema))
    else:
        keys = keys.distinct()
    joined = history.join(keys.withColumn("_tg_hit", F.lit(True)), scope_cols, "left")
    others = [F.col(c) for c in history.columns if c not in (VALID_TO, CURRENT)]
    hit = F.coalesce(F.col("_tg_hit"), F.lit(False))
    return joined.select(*others, *_expire_when(hit, as_of)).select(*history.columns)


def append_merge_schema(base: DataFrame, new: DataFrame) -> DataFrame:
    """Append by column name; columns missing on either side become NULL."""
    return base.unionByName(new, allowMissingColumns=True)


def expire_and_append(history: DataFrame, incoming: DataFrame, scope_cols: list[str], as_of,
                      file_name: str | Column | None = None, month_domain: bool = False) -> DataFrame:
    """Full reload of a scope: scope = keys present both in the current
    history and the incoming rows; expire them; append the stamped rows.
    ``month_domain`` states that the scope is a month of ``with_month``: its
    keys, 12 x 9999 at most, are ``listed``."""
    scope = reprocess_scope(history.filter(F.col(CURRENT)), incoming, scope_cols)
    expired = expire_scope(history, scope, scope_cols, as_of, listed=month_domain)
    return append_merge_schema(expired, stamp_history(incoming, as_of, file_name))


def next_runs(pairs: DataFrame, scope_cols: list[str] | None, run_col: str = RUN,
              from_col: str = VALID_FROM) -> DataFrame:
    """(scope, run) pairs with ``_tg_next``: the stamp of the next run that
    wrote the same scope (NULL = still current; NULL scope keys never expire).

    Without a scope every run supersedes the whole table; the window then
    runs over one row per run."""
    scope = list(scope_cols or [])
    runs = pairs.select(*scope, run_col, from_col).distinct()
    nxt = F.lead(from_col).over(Window.partitionBy(*scope).orderBy(run_col))
    if scope:
        nxt = F.when(reduce_or([F.col(c).isNull() for c in scope]), F.lit(None)).otherwise(nxt)
    return runs.select(*[F.col(c).alias(f"_tg_s_{c}") for c in scope], F.col(run_col).alias("_tg_run"),
                       nxt.cast("timestamp_ntz").alias("_tg_next"))


def newest_runs(pairs: DataFrame, scope_cols: list[str], run_col: str = RUN) -> DataFrame:
    """The (scope, run) pairs that no later run supersedes, in the form of
    ``next_runs``; every pair with a NULL scope key is one."""
    rank = F.row_number().over(Window.partitionBy(*scope_cols).orderBy(F.col(run_col).desc()))
    rank = F.when(reduce_or([F.col(c).isNull() for c in scope_cols]), F.lit(1)).otherwise(rank)
    return pairs.withColumn("_tg_rank", rank).filter(F.col("_tg_rank") == 1).select(
        *[F.col(c).alias(f"_tg_s_{c}") for c in scope_cols], F.col(run_col).alias("_tg_run"),
        F.lit(None).cast("timestamp_ntz").alias("_tg_next"))


def with_validity(rows: DataFrame, nxt: DataFrame, scope_cols: list[str] | None,
                  run_col: str = RUN, how: str = "left") -> DataFrame:
    """Join ``next_runs`` to the rows: valid_to and is_current."""
    cond = [F.col(run_col) == F.col("_tg_run")] + [
        F.col(c).eqNullSafe(F.col(f"_tg_s_{c}")) for c in scope_cols or []]
    base = [F.col(c) for c in rows.columns if c not in (VALID_TO, CURRENT)]
    return rows.join(nxt, reduce_and(cond), how).select(
        *base, F.col("_tg_next").alias(VALID_TO), F.col("_tg_next").isNull().alias(CURRENT))


def derive_validity(rows: DataFrame, scope_cols: list[str] | None, run_col: str = RUN,
                    from_col: str = VALID_FROM) -> DataFrame:
    """Append-only rows -> valid_to / is_current.

    valid_to = ``from_col`` of the next run (by ``run_col``) that wrote rows
    of the same scope; ``scope_cols`` None = every run supersedes the whole
    table.  Rows with a NULL scope key never expire."""
    return with_validity(rows, next_runs(rows, scope_cols, run_col, from_col), scope_cols, run_col)


def reduce_and(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out & c
    return out


def reduce_or(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out | c
    return out


def current_rows(history: DataFrame) -> DataFrame:
    return history.filter(F.col(CURRENT))
