"""Physical data-quality gate, row rules, routing, error log and counts.

One evaluation of the rule expressions feeds everything: the batch gate (an
aggregate per batch key), the per-row reason list, the accepted/rejected
split, the long-form error log and the counts.  No per-rule action, no
driver-side rows.

Semantics
* Batch rules (``reject_all``): if any row of a batch fails any of them, the
  whole batch is rejected with the comma list of failed batch rules (rule
  order) and row rules are not applied to it.
* Row rules: per row, comma list of failing rule ids in rule order; an empty
  list means accepted.
* A rule whose outcome is unknown (NULL) passes.
* Error log: one row per (rule, row, value) failure of the rules that decided
  the row's fate; a NULL value is logged as the text ``None``; each rule logs
  its own column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.rules import Rule, check_columns, failure

REASONS = "reject_reasons"
GATE = "gate_failed"
FILE = "file_name"  # lineage column of an ingest: one value per listed extract
NULL_VALUE_TEXT = "None"


def _split(rules: list[Rule]) -> tuple[list[Rule], list[Rule]]:
    return [r for r in rules if r.reject_all], [r for r in rules if not r.reject_all]


def failed_ids(rules: list[Rule]) -> Column:
    """array<string> of ids of the rules this row fails, in rule order."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(failure(r), F.lit(r.id_text)) for r in rules]))


def reason_text(rules: list[Rule]) -> Column:
    return F.array_join(failed_ids(rules), ",")


def gate_table(df: DataFrame, rules: list[Rule], batch_key: str | list[str]) -> DataFrame:
    """Per batch: comma list of batch rules failed by at least one row
    ('' = the batch passes).  One partial aggregate per task, then one row
    per batch key."""
    batch, _ = _split(rules)
    keys = [batch_key] if isinstance(batch_key, str) else list(batch_key)
    if not batch:
        return df.select(*keys).distinct().withColumn(GATE, F.lit(""))
    flags = [F.when(F.bool_or(failure(r)), F.lit(r.id_text)) for r in batch]
    return df.groupBy(*keys).agg(F.array_join(F.array_compact(F.array(*flags)), ",").alias(GATE))


def gate_scalar(df: DataFrame, rules: list[Rule]) -> Column:
    """Whole-frame gate as a scalar subquery column (computed once)."""
    batch, _ = _split(rules)
    if not batch:
        return F.lit("")
    flags = [F.when(F.bool_or(failure(r)), F.lit(r.id_text)) for r in batch]
    return df.agg(F.array_join(F.array_compact(F.array(*flags)), ",").alias(GATE)).scalar()


def with_gate(df: DataFrame, rules: list[Rule], batch_key: str | list[str] | None = None) -> DataFrame:
    """Attach the gate decision of each row's batch as column ``gate_failed``.

    ``batch_key`` None = the whole frame is one batch.  For the extract name
    (``FILE``) the per-batch table has one row per listed file, which Spark
    already holds in the driver's file index, so it is broadcast; any other
    key is joined without a hint."""
    if batch_key is None:
        return df.withColumn(GATE, gate_scalar(df, rules))
    keys = [batch_key] if isinstance(batch_key, str) else list(batch_key)
    g = gate_table(df, rules, keys).select(
        *[F.col(k).alias(f"_tg_gate_{k}") for k in keys], F.col(GATE))
    if keys == [FILE]:
        g = F.broadcast(g)
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"_tg_gate_{k}")) for k in keys])
    return df.join(g, cond, "left").select(
        *[F.col(c) for c in df.columns], F.coalesce(F.col(GATE), F.lit("")).alias(GATE))


def evaluate(df: DataFrame, rules: list[Rule], batch_key: str | list[str] | None = None,
             keep_gate: bool = False) -> DataFrame:
    """Add ``reject_reasons`` ('' = accepted) to every row, in one pass."""
    check_columns(df, rules)
    _, row = _split(rules)
    gated = with_gate(df, rules, batch_key)
    out = gated.withColumn(
        REASONS, F.when(F.col(GATE) != "", F.col(GATE)).otherwise(reason_text(row)))
    return out if keep_gate else out.drop(GATE)


def accepted(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(F.col(REASONS) == "").drop(REASONS)


def rejected(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(F.col(REASONS) != "")


def split(df: DataFrame, rules: list[Rule], batch_key=None) -> tuple[DataFrame, DataFrame]:
    ev = evaluate(df, rules, batch_key)
    return accepted(ev), rejected(ev)


def failure_entries(rules: list[Rule]) -> Column:
    """array<struct<rule_id, error_value>> of this row's failures."""
    if not rules:
        return F.array().cast("array<struct<rule_id:bigint,error_value:string>>")
    entries = [F.when(failure(r), F.struct(
        F.lit(r.rule_id).cast("bigint").alias("rule_id"),
        F.coalesce(F.col(r.column).cast("string"), F.lit(NULL_VALUE_TEXT)).alias("error_value")))
        for r in rules]
    return F.array_compact(F.array(*entries))


def error_log(df: DataFrame, rules: list[Rule], run_id: int, row_id_col: str = "row_id",
              batch_key: str | list[str] | None = None) -> DataFrame:
    """Long-form error log: run_id, rule_id, row_id, error_value.

    Rows of a gated batch log their batch-rule failures; rows of a passing
    batch log their row-rule failures.  Row ids are unique, so no distinct
    (and no shuffle) is needed."""
    check_columns(df, rules)
    return error_log_gated(with_gate(df, rules, batch_key), rules, run_id, row_id_col)


def error_log_gated(gated: DataFrame, rules: list[Rule], run_id: int,
                    row_id_col: str = "row_id") -> DataFrame:
    """Error log of a frame that already carries ``gate_failed``."""
    batch, row = _split(rules)
    entries = F.when(F.col(GATE) != "", failure_entries(batch)).otherwise(failure_entries(row))
    return (gated.select(F.col(row_id_col).alias("row_id"), F.explode(entries).alias("e"))
                 .select(F.lit(run_id).cast("bigint").alias("run_id"), F.col("e.rule_id"),
                         "row_id", F.col("e.error_value")))


ROW_FAILS, BATCH_FAILS = "_tg_row_fails", "_tg_batch_fails"


def failure_columns(df: DataFrame, rules: list[Rule], skip: Column | None = None) -> list[Column]:
    """A row's failures of the row rules and of the batch rules, as arrays of
    (rule_id, error_value) in rule order.  Rows where ``skip`` holds have none.
    Reasons, gate, log and counts follow from them without evaluating a rule
    again."""
    check_columns(df, rules)
    batch, row = _split(rules)
    out = []
    for own, name in ((row, ROW_FAILS), (batch, BATCH_FAILS)):
        entries = failure_entries(own)
        out.append((entries if skip is None else F.when(~skip, entries).otherwise(failure_entries([]))).alias(name))
    return out


def batch_summary(failed: DataFrame, rules: list[Rule], batch_key: str, ok: Column) -> DataFrame:
    """Per batch, from a frame with ``failure_columns``: source rows, rows that
    pass every row rule (of those that are ``ok``), and the gate decision.  One
    partial aggregate over the failure columns alone."""
    batch, _ = _split(rules)

    def fails(rule: Rule) -> Column:
        return F.exists(BATCH_FAILS, lambda e: e["rule_id"] == rule.rule_id)

    flags = [F.when(F.bool_or(fails(r)), F.lit(r.id_text)) for r in batch]
    gate = F.array_join(F.array_compact(F.array(*flags)), ",") if flags else F.lit("")
    return failed.groupBy(batch_key).agg(
        F.count(F.lit(1)).alias("source_rows"), F.count_if((F.size(ROW_FAILS) == 0) & ok).alias("passing_rows"), gate.alias(GATE))


def fail_reasons(entries: str) -> Column:
    """Comma list of the rule ids of a failure column."""
    return F.array_join(F.transform(entries, lambda e: e["rule_id"].cast("string")), ",")


def log_failures(gated: DataFrame, run_id: int, row_id_col: str = "row_id") -> DataFrame:
    """Error log of a frame that carries failures and ``gate_failed``."""
    some = gated.filter((F.size(ROW_FAILS) > 0) | (F.size(BATCH_FAILS) > 0))
    entries = F.when(F.col(GATE) != "", F.col(BATCH_FAILS)).otherwise(F.col(ROW_FAILS))
    return (some.select(F.col(row_id_col).alias("row_id"), F.explode(entries).alias("e"))
                .select(F.lit(run_id).cast("bigint").alias("run_id"), F.col("e.rule_id"), "row_id", F.col("e.error_value")))


def rule_fail_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Failing rows per rule (every rule evaluated), one aggregate pass; long
    form (rule_id, failed_rows)."""
    check_columns(df, rules)
    aggs = [F.count_if(failure(r)).cast("bigint").alias(f"r{r.rule_id}") for r in rules]
    wide = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(r.rule_id).cast("bigint").alias("rule_id"),
                               F.col(f"r{r.rule_id}").alias("failed_rows")) for r in rules])
    return wide.select(F.explode(pairs).alias("p")).select("p.rule_id", "p.failed_rows")


def route_counts(evaluated: DataFrame, by: list[str] | None = None) -> DataFrame:
    """source / accepted / rejected row counts of an evaluated frame."""
    is_ok = F.col(REASONS) == ""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("source_rows"),
            F.count_if(is_ok).cast("bigint").alias("accepted_rows"),
            F.count_if(~is_ok).cast("bigint").alias("rejected_rows")]
    return evaluated.groupBy(*(by or [])).agg(*aggs)


def rule_outcomes(df: DataFrame, rules: list[Rule], keep: list[str]) -> DataFrame:
    """Per row, ``pass``/``fail`` for each rule (columns ``rule_<id>``)."""
    check_columns(df, rules)
    return df.select(*keep, *[F.when(failure(r), F.lit("fail")).otherwise(F.lit("pass"))
                              .alias(f"rule_{r.rule_id}") for r in rules])
