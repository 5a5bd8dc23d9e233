"""Rule rows -> boolean Columns.

A rule row names a column, a rule code and a detail string.  Each code
compiles to a *pass* condition; the failure flag is its negation under
three-valued logic where an unknown (NULL) outcome counts as a pass, which
is how ``filter(~cond)`` and ``when(~cond, ...)`` behave.

Rule detail text is SQL evaluated with ``F.expr``: the rule table is trusted
configuration.  Column names are checked against the frame before use.
"""

from __future__ import annotations

import ast
import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Rule codes, rule types and the active status code.
DATE_FORMAT = "date_format"
NUMERIC_FORMAT = "numeric_format"
OUT_OF_RANGE = "out_of_range"
NOT_NULL = "not_null"
CONDITIONAL_FAIL = "conditional_fail"
CROSS_REFERENCE = "cross_reference"
PHYSICAL = "PH"
BUSINESS = "BS"
ACTIVE = "A"

RULE_SCHEMA = T.StructType([
    T.StructField("rule_id", T.LongType(), False),
    T.StructField("process_id", T.IntegerType(), False),
    T.StructField("rule_type", T.StringType(), False),
    T.StructField("object_type", T.StringType(), True),
    T.StructField("description", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("rule_code", T.StringType(), True),
    T.StructField("rule_detail", T.StringType(), True),
    T.StructField("master_table", T.StringType(), True),
    T.StructField("reject_all", T.IntegerType(), False),
    T.StructField("status", T.StringType(), False),
])


@dataclass(frozen=True)
class Rule:
    rule_id: int
    column: str
    code: str | None
    detail: str | None = None
    reject_all: bool = False
    master_table: str | None = None
    keys: tuple[tuple[str, str], ...] = field(default_factory=tuple)

    @property
    def id_text(self) -> str:
        return str(self.rule_id)


def parse_key_pairs(detail: str | None) -> tuple[tuple[str, str], ...]:
    """``[("src", "master"), ...]`` text -> tuple of pairs (literal syntax only)."""
    if not detail:
        return ()
    value = ast.literal_eval(detail)
    pairs = tuple((str(a), str(b)) for a, b in value)
    return pairs


def rules_from_rows(rows) -> list[Rule]:
    out = []
    for r in rows:
        d = r.asDict() if hasattr(r, "asDict") else dict(r)
        code = d.get("rule_code")
        keys = parse_key_pairs(d.get("rule_detail")) if code == CROSS_REFERENCE else ()
        out.append(Rule(rule_id=int(d["rule_id"]), column=d["column_name"], code=code,
                        detail=d.get("rule_detail"), reject_all=int(d.get("reject_all") or 0) == 1,
                        master_table=d.get("master_table"), keys=keys))
    return sorted(out, key=lambda r: r.rule_id)


def collect_rules(rules_df: DataFrame) -> list[Rule]:
    """The rules to compile, ordered by id: one row per rule, as written by
    the people who maintain them."""
    return rules_from_rows(rules_df.collect())


def pass_condition(rule: Rule) -> Column:
    """The rule's pass predicate (may evaluate to NULL = unknown)."""
    c = F.col(rule.column)
    code = rule.code
    if code == DATE_FORMAT:
        return F.try_to_date(c, rule.detail).isNotNull() | c.isNull()
    if code == NUMERIC_FORMAT:
        return c.try_cast(rule.detail).isNotNull() | c.isNull()
    if code == OUT_OF_RANGE:
        return F.expr(f"{rule.column} {rule.detail}") | c.isNull()
    if code == NOT_NULL:
        return c.isNotNull()
    if code == CONDITIONAL_FAIL:
        return ~F.expr(rule.detail)
    log.warning("rule %s has unknown code %r; it always passes", rule.rule_id, code)
    return F.lit(True)


def failure(rule: Rule) -> Column:
    """TRUE when the row fails the rule; an unknown outcome is a pass."""
    return F.coalesce(~pass_condition(rule), F.lit(False))


def check_columns(df: DataFrame, rules: list[Rule]) -> None:
    missing = sorted({r.column for r in rules} - set(df.columns))
    if missing:
        raise ValueError(f"rules name columns absent from the frame: {missing}")


def active_rules(runs: DataFrame, rules: DataFrame, run_id: int, rule_type: str) -> DataFrame:
    """Rules of the run's process, of one type, with active status.

    ``runs`` needs (run_id, process_id)."""
    run = runs.filter(F.col("run_id") == F.lit(run_id)).select("run_id", "process_id")
    return (run.join(rules, "process_id", "inner")
               .filter((F.col("rule_type") == rule_type) & (F.col("status") == ACTIVE))
               .select("rule_id", "column_name", "rule_code", "rule_detail",
                       "reject_all", "master_table"))


def rules_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RULE_SCHEMA)


# The rule set of the ledger fixture, by (rule_id, process_id, rule_type,
# object_type, description, column_name, rule_code, rule_detail, master_table,
# reject_all, status).  Row rules come before and after the batch rules.
LEDGER_RULE_ROWS = [
    (11, 2, PHYSICAL, "row", "Line number is required", "doc_line", NOT_NULL, None, None, 0, ACTIVE),
    (12, 2, PHYSICAL, "row", "Line number is whole", "doc_line", NUMERIC_FORMAT, "integer", None, 0, ACTIVE),
    (13, 2, PHYSICAL, "row", "Amount is a number", "amount_lc", NUMERIC_FORMAT, "decimal(15,5)", None, 0, ACTIVE),
    (21, 2, PHYSICAL, "file", "Sender is known", "source_system", NOT_NULL, None, None, 1, ACTIVE),
    (22, 2, PHYSICAL, "file", "Posting day is in the calendar", "posting_date", DATE_FORMAT, "yyyyMMdd", None, 1, ACTIVE),
    (23, 2, PHYSICAL, "file", "Document has a number", "doc_number", OUT_OF_RANGE, "> '0'", None, 1, ACTIVE),
    (24, 2, PHYSICAL, "file", "No test documents", "doc_number", CONDITIONAL_FAIL,
     "doc_type = 'XX' OR company_code = 'C99'", None, 1, ACTIVE),
    (14, 2, PHYSICAL, "row", "Few lines a document", "doc_line", OUT_OF_RANGE, "< '7'", None, 0, ACTIVE),
    (15, 2, PHYSICAL, "row", "Open return needs a vendor", "vendor_code", CONDITIONAL_FAIL,
     "doc_type = 'RF' AND vendor_code IS NULL", None, 0, ACTIVE),
    (16, 2, PHYSICAL, "row", "Posted after entry", "posting_date", OUT_OF_RANGE, ">= entry_date", None, 0, "R"),
    (31, 3, BUSINESS, "row", "Company exists", "company_code", CROSS_REFERENCE,
     '[("company_code", "company_code")]', "master_company", 0, ACTIVE),
    (32, 3, BUSINESS, "row", "Vendor of the company exists", "vendor_code", CROSS_REFERENCE,
     '[("vendor_code", "vendor_id"), ("company_code", "company_code")]', "master_vendor", 0, ACTIVE),
]


def ledger_rules(spark: SparkSession) -> DataFrame:
    return rules_frame(spark, LEDGER_RULE_ROWS)


def ledger_rule_list(rule_type: str = PHYSICAL, active_only: bool = True) -> list[Rule]:
    """The seeded rules as driver objects (no Spark job needed)."""
    rows = [dict(zip(RULE_SCHEMA.fieldNames(), r)) for r in LEDGER_RULE_ROWS]
    rows = [r for r in rows if r["rule_type"] == rule_type
            and (not active_only or r["status"] == ACTIVE)]
    return rules_from_rows(rows)


def active_rules_for_runs(runs: DataFrame, rules: DataFrame, rule_type: str) -> DataFrame:
    """Active rules of one type for every run, via its process."""
    r = rules.filter((F.col("rule_type") == rule_type) & (F.col("status") == ACTIVE))
    return (runs.select("run_id", "process_id")
                .join(r, "process_id", "inner")
                .select("run_id", "rule_id", "column_name", "rule_code", "rule_detail",
                        "reject_all", "master_table"))
