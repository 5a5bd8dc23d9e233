"""Referential (cross-reference) checks against master tables.

Each ``cross_reference`` rule lists (source column, master column) pairs.  A
row misses the rule when no master row matches on all pairs.  The source is
sentinel-filled first (NULL -> ``UNSP``), so NULL keys compare as text.

Evaluation is one left join per rule against the master's *distinct key
columns* with a hit flag, so every rule's outcome lands on the row in a
single pass and the row count is preserved.  The join carries no hint:
Catalyst and AQE broadcast the keys when their measured size allows it, and
split skewed partitions of the source side otherwise.

Outputs:
* ``annotate``: every row kept; the key columns of each missed rule become
  ``TBD`` (``UNSP`` stays).  All missed rules of a row apply together.
* ``reject`` / ``accept``: rows missing any rule, with the comma list of
  missed rule ids and their ``UNSP``/``TBD`` markers; the rest.
* ``error_log``: one row per (rule, row) miss with the key values joined by
  ``||``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.columns import fill_sentinel, lookup_marker
from tollgate.functions.rules import CROSS_REFERENCE, Rule

MasterResolver = Callable[[str], DataFrame | None]
REASONS = "reject_reasons"
ERROR_VALUE = "error_value"
ENTRIES = "_tg_entries"

SKIP, FAIL, REJECT_ALL = "skip", "fail", "reject_all"


def catalog_resolver(spark: SparkSession) -> MasterResolver:
    def resolve(name: str) -> DataFrame | None:
        return spark.table(name) if spark.catalog.tableExists(name) else None
    return resolve


def mapping_resolver(tables: Mapping[str, DataFrame]) -> MasterResolver:
    return lambda name: tables.get(name)


def miss_col(rule: Rule) -> str:
    return f"_tg_miss_{rule.rule_id}"


def _master_keys(master: DataFrame, rule: Rule) -> tuple[DataFrame, Column]:
    """The master's distinct keys with a hit flag, and how a row meets them."""
    names = {s: f"_tg_k{rule.rule_id}_{m}" for s, m in rule.keys}
    keys = master.select(*[F.col(m).alias(names[s]) for s, m in rule.keys]).distinct()
    meets = reduce(and_, [F.col(s) == F.col(k) for s, k in names.items()])
    return keys.withColumn(f"_tg_hit{rule.rule_id}", F.lit(True)), meets


def flag_misses(filled: DataFrame, rules: list[Rule], resolve: MasterResolver,
                missing_master: str = SKIP) -> tuple[DataFrame, list[Rule]]:
    """Add one boolean miss column per applied rule.  Returns the frame and
    the rules that were applied (rules with an absent master are skipped,
    raise, or miss on every row, by ``missing_master``)."""
    out, applied = filled, []
    for rule in sorted((r for r in rules if r.code == CROSS_REFERENCE), key=lambda r: r.rule_id):
        master = resolve(rule.master_table) if rule.master_table else None
        if master is None:
            if missing_master == FAIL:
                raise LookupError(f"master table {rule.master_table!r} of rule {rule.rule_id} not found")
            if missing_master == REJECT_ALL:
                out = out.withColumn(miss_col(rule), F.lit(True))
                applied.append(rule)
            continue
        keys, meets = _master_keys(master, rule)
        hit = f"_tg_hit{rule.rule_id}"
        out = (out.join(keys, meets, "left")
                  .select(*[F.col(c) for c in out.columns], F.col(hit).isNull().alias(miss_col(rule))))
        applied.append(rule)
    return out, applied


def _annotated(columns: list[str], applied: list[Rule]) -> list[Column]:
    """The columns with the keys of every missed rule marked."""
    out = []
    for c in columns:
        misses = [F.col(miss_col(r)) for r in applied if c in [s for s, _ in r.keys]]
        out.append(F.when(reduce(or_, misses), lookup_marker(c)).otherwise(F.col(c)).alias(c)
                   if misses else F.col(c))
    return out


def annotate(df: DataFrame, rules: list[Rule], resolve: MasterResolver,
             missing_master: str = SKIP) -> DataFrame:
    """Sentinel-fill, then mark the key columns of every missed rule."""
    filled = fill_sentinel(df)
    flagged, applied = flag_misses(filled, rules, resolve, missing_master)
    return flagged.select(*_annotated(filled.columns, applied))


def _missed_ids(applied: list[Rule]) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(miss_col(r)), F.lit(str(r.rule_id)))
                                     for r in applied]))


def _markers(applied: list[Rule]) -> Column:
    per_rule = [F.when(F.col(miss_col(r)),
                       F.concat_ws("||", *[lookup_marker(s) for s, _ in r.keys])) for r in applied]
    return F.array_join(F.array_compact(F.array(*per_rule)), "||")


def evaluate(df: DataFrame, rules: list[Rule], resolve: MasterResolver,
             missing_master: str = SKIP, keep_entries: bool = False) -> DataFrame:
    """Sentinel-filled rows + ``reject_reasons`` ('' = all lookups hit) +
    ``error_value`` (UNSP/TBD markers of the missed rules); with
    ``keep_entries`` also the error-log entries of the row."""
    filled = fill_sentinel(df)
    flagged, applied = flag_misses(filled, rules, resolve, missing_master)
    reasons = F.array_join(_missed_ids(applied), ",") if applied else F.lit("")
    markers = _markers(applied) if applied else F.lit("")
    out = [*[F.col(c) for c in filled.columns], reasons.alias(REASONS), markers.alias(ERROR_VALUE)]
    return flagged.select(*out, *([_entries(applied).alias(ENTRIES)] if keep_entries else []))


def flagged_rows(df: DataFrame, rules: list[Rule], resolve: MasterResolver,
                 missing_master: str = SKIP) -> tuple[DataFrame, list[Rule]]:
    """Sentinel-filled rows with one miss flag per applied rule, and those
    rules: what annotating, rejecting and logging need, without a join."""
    return flag_misses(fill_sentinel(df), rules, resolve, missing_master)


def annotated_from(flagged: DataFrame, columns: list[str], applied: list[Rule]) -> DataFrame:
    """``annotate`` of rows that carry their flags; ``columns`` are kept."""
    return flagged.select(*_annotated(columns, applied))


def judged_from(flagged: DataFrame, columns: list[str], applied: list[Rule]) -> DataFrame:
    """``evaluate`` of rows that carry their flags; ``columns`` are kept."""
    reasons = F.array_join(_missed_ids(applied), ",") if applied else F.lit("")
    markers = _markers(applied) if applied else F.lit("")
    return flagged.select(*[F.col(c) for c in columns], reasons.alias(REASONS), markers.alias(ERROR_VALUE))


def missed_any(applied: list[Rule]) -> Column:
    """TRUE where a row misses a rule's lookup."""
    return reduce(or_, [F.col(miss_col(r)) for r in applied]) if applied else F.lit(False)


def log_misses(flagged: DataFrame, applied: list[Rule], run_id: int, row_id_col: str = "row_id") -> DataFrame:
    """Error log of rows that carry their flags; hits are not looked at."""
    return log_entries(flagged.filter(missed_any(applied)).withColumn(ENTRIES, _entries(applied)), run_id, row_id_col)


def _entries(applied: list[Rule]) -> Column:
    """array<struct<rule_id, error_value>> of the rules a row misses."""
    if not applied:
        return F.array().cast(f"array<struct<rule_id:bigint,{ERROR_VALUE}:string>>")
    return F.array_compact(F.array(*[
        F.when(F.col(miss_col(r)), F.struct(
            F.lit(r.rule_id).cast("bigint").alias("rule_id"),
            F.concat_ws("||", *[F.col(s) for s, _ in r.keys]).alias(ERROR_VALUE)))
        for r in applied]))


def log_entries(evaluated: DataFrame, run_id: int, row_id_col: str = "row_id") -> DataFrame:
    """Error log of a frame that carries its entries."""
    return (evaluated.select(F.col(row_id_col).alias("row_id"), F.explode(ENTRIES).alias("e"))
                     .select(F.lit(run_id).cast("bigint").alias("run_id"), "e.rule_id", "row_id",
                             F.col(f"e.{ERROR_VALUE}").alias(ERROR_VALUE)))


def reject(df: DataFrame, rules: list[Rule], resolve: MasterResolver,
           missing_master: str = SKIP) -> DataFrame:
    return evaluate(df, rules, resolve, missing_master).filter(F.col(REASONS) != "")


def accept(df: DataFrame, rules: list[Rule], resolve: MasterResolver,
           missing_master: str = SKIP) -> DataFrame:
    return (evaluate(df, rules, resolve, missing_master)
            .filter(F.col(REASONS) == "").drop(REASONS, ERROR_VALUE))


def anti(df: DataFrame, rule: Rule, resolve: MasterResolver) -> DataFrame:
    """Sentinel-filled rows with no master match for one rule."""
    filled = fill_sentinel(df)
    keys, meets = _master_keys(resolve(rule.master_table), rule)
    return filled.join(keys, meets, "left_anti")


def error_log(df: DataFrame, rules: list[Rule], resolve: MasterResolver, run_id: int,
              row_id_col: str = "row_id", missing_master: str = SKIP) -> DataFrame:
    """run_id, rule_id, row_id, error_value (key values joined by ``||``);
    empty when no rule applies."""
    return log_entries(evaluate(df, rules, resolve, missing_master, keep_entries=True), run_id, row_id_col)


def miss_matrix(df: DataFrame, rules: list[Rule], resolve: MasterResolver) -> DataFrame:
    """Row counts per combination of missed rules (one aggregate pass)."""
    flagged, applied = flag_misses(fill_sentinel(df), rules, resolve)
    return flagged.groupBy(*[F.col(miss_col(r)).alias(f"miss_{r.rule_id}") for r in applied]) \
                  .agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
