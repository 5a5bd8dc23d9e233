"""DuckDB oracle statements, keyed like the registered queries."""

from __future__ import annotations

# Fixed values shared with the fixture definition (FIXTURES.md section 2.1).
F1 = "ledger_20240101_120000.txt"
F2 = "ledger_20240102_120000.txt"
F3 = "ledger_20240103_120000.txt"
F4 = "ledger_20240104_120000.txt"
FILES = [F1, F2, F3, F4]
FIRST, SECOND = f"('{F1}', '{F2}')", f"('{F3}', '{F4}')"
RUN = 7

LEDGER_COLS = ["source_system", "company_code", "posting_date", "doc_type", "doc_number",
               "doc_line", "entry_date", "amount_lc", "vendor_code", "file_name"]


def ledger_select() -> str:
    return f"""SELECT
      CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE 'SYS' || CAST(l_orderkey % 2 AS VARCHAR) END AS source_system,
      'C' || CAST(l_suppkey % 25 AS VARCHAR) AS company_code,
      (CASE WHEN l_orderkey % 89 = 0 THEN 'x' ELSE '' END) || strftime(l_shipdate, '%Y%m%d') AS posting_date,
      l_returnflag || l_linestatus AS doc_type,
      CAST(l_orderkey AS VARCHAR) AS doc_number,
      CASE WHEN l_partkey % 53 = 0 THEN NULL
           WHEN l_partkey % 47 = 0 THEN CAST(l_linenumber AS VARCHAR) || '.5'
           ELSE CAST(l_linenumber AS VARCHAR) END AS doc_line,
      strftime(o_orderdate, '%Y%m%d') AS entry_date,
      CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR)
        || (CASE WHEN l_partkey % 41 = 0 THEN '-' ELSE '' END) AS amount_lc,
      CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE 'V' || CAST(l_suppkey AS VARCHAR) END AS vendor_code,
      CASE WHEN l_orderkey % 97 = 0 OR l_orderkey % 89 = 0 THEN '{F4}'
           WHEN month(l_shipdate) % 3 = 0 AND l_orderkey % 3 = 2 THEN '{F3}'
           WHEN month(l_shipdate) % 2 = 0 AND l_orderkey % 3 = 1 THEN '{F2}'
           ELSE '{F1}' END AS file_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


LEDGER = f"ledger AS ({ledger_select()})"

# Pass conditions of the ledger's rules (and the extra ones) in DuckDB terms.
PASS = {
    11: "(doc_line IS NOT NULL)",
    12: "(regexp_full_match(trim(doc_line), '[+-]?[0-9]+') OR doc_line IS NULL)",
    13: "(try_cast(amount_lc AS DECIMAL(15,5)) IS NOT NULL OR amount_lc IS NULL)",
    14: "(doc_line < '7' OR doc_line IS NULL)",
    15: "(NOT (doc_type = 'RF' AND vendor_code IS NULL))",
    16: "(posting_date >= entry_date OR posting_date IS NULL)",
    21: "(source_system IS NOT NULL)",
    22: "(try_strptime(posting_date, '%Y%m%d') IS NOT NULL OR posting_date IS NULL)",
    23: "(doc_number > '0' OR doc_number IS NULL)",
    24: "(NOT (doc_type = 'XX' OR company_code = 'C99'))",
    91: "(TRUE)",
    92: "(doc_type < vendor_code OR doc_type IS NULL)",
    93: "(NOT (doc_line > '5'))",
}
COLUMN = {11: "doc_line", 12: "doc_line", 13: "amount_lc", 14: "doc_line", 15: "vendor_code",
          21: "source_system", 22: "posting_date", 23: "doc_number", 24: "doc_number"}
BATCH = [21, 22, 23, 24]
ROW = [11, 12, 13, 14, 15]


def fail(i: int) -> str:
    return f"(CASE WHEN NOT {PASS[i]} THEN TRUE ELSE FALSE END)"


def outcome(i: int) -> str:
    return f"CASE WHEN {fail(i)} THEN 'fail' ELSE 'pass' END AS rule_{i}"


def reasons(ids: list[int]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {fail(i)} THEN '{i}' END" for i in ids) + ")"


def gate_agg(ids: list[int] = BATCH) -> str:
    return "concat_ws(',', " + ", ".join(
        f"CASE WHEN bool_or({fail(i)}) THEN '{i}' END" for i in ids) + ")"


def order_all(cols: list[str]) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


ORACLES: dict[str, str] = {}

# ---------------------------------------------------------------- rules ---
ORACLES["rule_not_null"] = (
    f"WITH {LEDGER} SELECT doc_number, posting_date, source_system, doc_line, "
    f"{outcome(11)}, {outcome(21)} FROM ledger")
ORACLES["rule_date_format"] = f"WITH {LEDGER} SELECT doc_number, posting_date, {outcome(22)} FROM ledger"
ORACLES["rule_numeric_format"] = (
    f"WITH {LEDGER} SELECT doc_number, amount_lc, doc_line, {outcome(12)}, {outcome(13)} FROM ledger")
ORACLES["rule_out_of_range"] = (
    f"WITH {LEDGER} SELECT doc_number, posting_date, entry_date, doc_line, {outcome(14)}, "
    f"{outcome(16)}, {outcome(23)} FROM ledger")
ORACLES["rule_conditional_fail"] = (
    f"WITH {LEDGER} SELECT doc_number, doc_type, vendor_code, company_code, {outcome(15)}, "
    f"{outcome(24)} FROM ledger")
ORACLES["rule_unknown_passes"] = f"WITH {LEDGER} SELECT doc_number, vendor_code, {outcome(91)} FROM ledger"
ORACLES["rule_null_semantics"] = (
    f"WITH {LEDGER} SELECT doc_number, doc_type, vendor_code, doc_line, {outcome(92)}, {outcome(93)} "
    "FROM ledger")

# -------------------------------------------------------- gate and rows ---
_EVAL_GLOBAL = (f"gate AS (SELECT {gate_agg()} AS g FROM ledger), "
                f"ev AS (SELECT ledger.*, CASE WHEN g <> '' THEN g ELSE {reasons(ROW)} END AS reject_reasons "
                "FROM ledger, gate)")
_EVAL_FILE = (f"gate AS (SELECT file_name AS gf, {gate_agg()} AS g FROM ledger GROUP BY file_name), "
              f"ev AS (SELECT ledger.*, CASE WHEN g <> '' THEN g ELSE {reasons(ROW)} END AS reject_reasons "
              "FROM ledger JOIN gate ON file_name = gf)")

ORACLES["row_rules"] = f"WITH {LEDGER}, {_EVAL_FILE} SELECT * FROM ev"
ORACLES["accepted_rows"] = (f"WITH {LEDGER}, {_EVAL_FILE} SELECT "
                            f"{', '.join(LEDGER_COLS)} FROM ev WHERE reject_reasons = ''")
ORACLES["rejected_rows"] = f"WITH {LEDGER}, {_EVAL_FILE} SELECT * FROM ev WHERE reject_reasons <> ''"


def log_rows(source: str, run: int, gate: str = "g") -> str:
    """Entries of a frame that has the extract's gate as ``gate``."""
    return " UNION ALL ".join(
        f"SELECT CAST({run} AS BIGINT) AS run_id, CAST({i} AS BIGINT) AS rule_id, row_id, "
        f"coalesce(CAST({COLUMN[i]} AS VARCHAR), 'None') AS error_value FROM {source} "
        f"WHERE {gate} {'<>' if i in BATCH else '='} '' AND {fail(i)}" for i in BATCH + ROW)


def _error_log(ledger_cte: str) -> str:
    ids = (f"ids AS (SELECT *, '{RUN}_' || CAST(row_number() OVER (ORDER BY {order_all(LEDGER_COLS)}) "
           "AS VARCHAR) AS row_id FROM ledger)")
    gate = (f"gate AS (SELECT file_name AS gf, {gate_agg()} AS g FROM ledger GROUP BY file_name), "
            "gated AS (SELECT * FROM ids JOIN gate ON file_name = gf)")
    return f"WITH {ledger_cte}, {ids}, {gate} SELECT DISTINCT * FROM ({log_rows('gated', RUN)})"


ORACLES["error_log"] = _error_log(LEDGER)
ORACLES["rule_fail_counts"] = (
    f"WITH {LEDGER} " + " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS rule_id, CAST(count(*) FILTER (WHERE {fail(i)}) AS BIGINT) "
        "AS failed_rows FROM ledger" for i in BATCH + ROW))
ORACLES["route_counts"] = (
    f"WITH {LEDGER}, {_EVAL_FILE} SELECT file_name, CAST(count(*) AS BIGINT) AS source_rows, "
    "CAST(count(*) FILTER (WHERE reject_reasons = '') AS BIGINT) AS accepted_rows, "
    "CAST(count(*) FILTER (WHERE reject_reasons <> '') AS BIGINT) AS rejected_rows "
    "FROM ev GROUP BY file_name")
ORACLES["gate_decision"] = (
    f"WITH {LEDGER} SELECT file_name, {gate_agg()} AS failed_rules, "
    f"{gate_agg()} = '' AS passed FROM ledger GROUP BY file_name")
ORACLES["gate_reject_all"] = (
    f"WITH {LEDGER}, {_EVAL_FILE} SELECT file_name, reject_reasons, "
    "CAST(count(*) AS BIGINT) AS rows FROM ev GROUP BY file_name, reject_reasons")
ORACLES["gate_whole_batch"] = (
    f"WITH {LEDGER}, {_EVAL_GLOBAL} SELECT reject_reasons, CAST(count(*) AS BIGINT) AS rows "
    "FROM ev GROUP BY reject_reasons")

# ------------------------------------------------------------- versions ---
STAMPS = [f"TIMESTAMP '2024-01-0{i} 09:00:00'" for i in range(1, 5)]
T1, T2, T3, T4 = STAMPS
NULL_TS = "CAST(NULL AS TIMESTAMP)"
MONTH_EXPR = "strftime(try_strptime(posting_date, '%Y%m%d'), '%Y%m')"
HL = f"hl AS (SELECT *, {MONTH_EXPR} AS posting_month FROM ledger)"

ORACLES["month_key"] = f"WITH {LEDGER} SELECT doc_number, posting_date, {MONTH_EXPR} AS posting_month FROM ledger"
ORACLES["latest_file_per_month"] = (
    f"WITH {LEDGER}, {HL} SELECT posting_month, max(file_name) AS file_name FROM hl GROUP BY posting_month")
ORACLES["latest_version"] = (
    f"WITH {LEDGER}, {HL}, lf AS (SELECT posting_month AS m, max(file_name) AS f FROM hl GROUP BY 1) "
    "SELECT hl.* FROM hl JOIN lf ON posting_month = m AND file_name = f")
ORACLES["reprocess_scope"] = (
    f"WITH {LEDGER}, {HL} SELECT DISTINCT posting_month FROM hl WHERE file_name IN {SECOND} "
    f"AND posting_month IN (SELECT posting_month FROM hl WHERE file_name IN {FIRST})")

# -------------------------------------------------------------- history ---
_RUN = "CASE file_name " + " ".join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(FILES, 1)) + " END"


def stamp_of(run: str) -> str:
    return f"CASE {run} " + " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(STAMPS, 1)) + f" ELSE {NULL_TS} END"


_SILVER = (f"WITH {LEDGER}, {HL}, hr AS (SELECT hl.*, {_RUN} AS r FROM hl), "
           "pm AS (SELECT DISTINCT posting_month AS m, r AS pr FROM hr), "
           "nx AS (SELECT a.m AS nm, a.pr AS npr, min(b.pr) AS nr FROM pm a JOIN pm b ON a.m = b.m AND b.pr > a.pr "
           "GROUP BY 1, 2), "
           f"sh AS (SELECT hr.* EXCLUDE (r), r, {stamp_of('r')} AS valid_from, {stamp_of('nr')} AS valid_to "
           "FROM hr LEFT JOIN nx ON nm = posting_month AND npr = r)")

ORACLES["stamp_history"] = (
    f"WITH {LEDGER}, {HL} SELECT hl.*, {T1} AS valid_from, {NULL_TS} AS valid_to, "
    "TRUE AS is_current FROM hl")
ORACLES["scd_expire_all"] = (
    f"WITH {LEDGER}, {HL} SELECT hl.*, CASE WHEN file_name IN {FIRST} THEN {T1} ELSE {T2} END "
    f"AS valid_from, CASE WHEN file_name IN {FIRST} THEN {T2} ELSE {NULL_TS} END AS valid_to, "
    f"file_name IN {SECOND} AS is_current FROM hl")
_SECOND_MONTHS = "coalesce(posting_month IN (SELECT m FROM m2), FALSE)"
ORACLES["scd_expire_scope"] = (
    f"WITH {LEDGER}, {HL}, m2 AS (SELECT DISTINCT posting_month AS m FROM hl WHERE file_name IN {SECOND} "
    f"AND posting_month IS NOT NULL) SELECT hl.*, {T1} AS valid_from, "
    f"CASE WHEN {_SECOND_MONTHS} THEN {T2} ELSE {NULL_TS} END AS valid_to, "
    f"NOT {_SECOND_MONTHS} AS is_current FROM hl WHERE file_name IN {FIRST}")
ORACLES["scd_expire_append"] = f"{_SILVER} SELECT * EXCLUDE (r), valid_to IS NULL AS is_current FROM sh"
ORACLES["current_rows"] = f"{_SILVER} SELECT * EXCLUDE (r), TRUE AS is_current FROM sh WHERE valid_to IS NULL"
ORACLES["scd_derived_validity"] = (
    f"{_SILVER} SELECT * EXCLUDE (r), CAST(r AS BIGINT) AS run_id, valid_to IS NULL AS is_current FROM sh")
ORACLES["scd_expire_rewrite"] = ORACLES["scd_expire_scope"]
ORACLES["scd_reload_rewrite"] = ORACLES["scd_expire_append"]
ORACLES["history_type_change"] = (
    f"{_SILVER} SELECT file_name, posting_month, CAST(doc_number AS BIGINT) AS doc_number, "
    "CASE WHEN r <> 3 AND regexp_full_match(doc_line, '[0-9]+') THEN CAST(doc_line AS INTEGER) END AS doc_line, "
    "CAST(try_cast(amount_lc AS DECIMAL(15,2)) AS DECIMAL(20,4)) AS amount_lc, "
    "CASE WHEN r >= 3 THEN strptime(entry_date, '%Y%m%d') END AS entry_date, valid_from, valid_to, "
    "CAST(r AS BIGINT) AS run_id, valid_to IS NULL AS is_current FROM sh")
ORACLES["append_merge_schema"] = (
    f"WITH {LEDGER}, {HL} "
    f"SELECT source_system, company_code, posting_date, doc_type, doc_number, file_name FROM hl "
    f"WHERE file_name IN {FIRST} UNION ALL BY NAME "
    "SELECT doc_number, doc_line, amount_lc, vendor_code, file_name, 'note-' || doc_type AS extra_note "
    f"FROM hl WHERE file_name IN {SECOND}")

# ----------------------------------------------------------- references ---
VENDOR = ("mv AS (SELECT DISTINCT 'C' || CAST(s_suppkey % 25 AS VARCHAR) AS company_code, "
          "'V' || CAST(s_suppkey AS VARCHAR) AS vendor_id FROM supplier WHERE s_suppkey % 7 <> 0)")
COMPANY = ("mc AS (SELECT 'C' || CAST(n_nationkey AS VARCHAR) AS company_code FROM nation "
           "WHERE n_nationkey % 11 <> 0)")
FILLED = "filled AS (SELECT " + ", ".join(f"coalesce({c}, 'UNSP') AS {c}" for c in LEDGER_COLS) + " FROM ledger)"
MISS32 = ("NOT EXISTS (SELECT 1 FROM mv WHERE mv.company_code = f.company_code "
         "AND mv.vendor_id = f.vendor_code)")
MISS31 = "NOT EXISTS (SELECT 1 FROM mc WHERE mc.company_code = f.company_code)"
FLAGS = f"flags AS (SELECT f.*, {MISS32} AS miss32, {MISS31} AS miss31 FROM filled f)"
XREF = f"WITH {LEDGER}, {VENDOR}, {COMPANY}, {FILLED}, {FLAGS}"


def marker(c: str) -> str:
    return f"CASE WHEN {c} = 'UNSP' THEN 'UNSP' ELSE 'TBD' END"


def _annot_cols(company_miss: str, vendor_miss: str | None) -> str:
    out = []
    for c in LEDGER_COLS:
        if c == "company_code":
            out.append(f"CASE WHEN {company_miss} THEN {marker(c)} ELSE {c} END AS {c}")
        elif c == "vendor_code" and vendor_miss:
            out.append(f"CASE WHEN {vendor_miss} THEN {marker(c)} ELSE {c} END AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


def xref_log(source: str, run: int) -> str:
    return (f"SELECT CAST({run} AS BIGINT) AS run_id, CAST(32 AS BIGINT) AS rule_id, row_id, "
            f"vendor_code || '||' || company_code AS error_value FROM {source} WHERE miss32 UNION ALL "
            f"SELECT CAST({run} AS BIGINT) AS run_id, CAST(31 AS BIGINT) AS rule_id, row_id, "
            f"company_code AS error_value FROM {source} WHERE miss31")


def xref_reasons() -> str:
    """reject_reasons and error_value of a flagged row."""
    return ("concat_ws(',', CASE WHEN miss31 THEN '31' END, CASE WHEN miss32 THEN '32' END) AS reject_reasons, "
            f"concat_ws('||', CASE WHEN miss31 THEN {marker('company_code')} END, "
            f"CASE WHEN miss32 THEN {marker('vendor_code')} || '||' || {marker('company_code')} END) AS error_value")


ORACLES["fill_sentinel"] = f"WITH {LEDGER}, {FILLED} SELECT * FROM filled"
ORACLES["xref_anti"] = f"WITH {LEDGER}, {VENDOR}, {FILLED} SELECT * FROM filled f WHERE {MISS32}"
ORACLES["xref_annotate"] = f"{XREF} SELECT {_annot_cols('(miss32 OR miss31)', 'miss32')} FROM flags"
ORACLES["xref_error_log"] = (
    f"WITH {LEDGER}, {VENDOR}, {COMPANY}, "
    f"ids AS (SELECT *, '{RUN}_' || CAST(row_number() OVER (ORDER BY {order_all(LEDGER_COLS)}) AS VARCHAR) "
    "AS row_id FROM ledger), "
    "filled AS (SELECT " + ", ".join(f"coalesce({c}, 'UNSP') AS {c}" for c in LEDGER_COLS) + ", row_id FROM ids), "
    f"{FLAGS} "
    + xref_log("flags", RUN))
_XEV = f"{XREF}, xev AS (SELECT {', '.join(LEDGER_COLS)}, {xref_reasons()} FROM flags)"
ORACLES["xref_reject"] = f"{_XEV} SELECT * FROM xev WHERE reject_reasons <> ''"
ORACLES["xref_accept"] = f"{_XEV} SELECT {', '.join(LEDGER_COLS)} FROM xev WHERE reject_reasons = ''"
ORACLES["xref_missing_master"] = f"{XREF} SELECT {_annot_cols('miss31', None)} FROM flags"
ORACLES["xref_miss_matrix"] = (
    f"{XREF} SELECT miss32 AS miss_32, miss31 AS miss_31, CAST(count(*) AS BIGINT) AS rows "
    "FROM flags GROUP BY 1, 2")

# ---------------------------------------------------------- fingerprint ---
HASH_ALL = "sha256(concat_ws('||', " + ", ".join(LEDGER_COLS) + "))"
ORACLES["row_fingerprint"] = f"WITH {LEDGER}, {FILLED} SELECT *, {HASH_ALL} AS row_hash FROM filled"
ORACLES["fingerprint_anti"] = (
    f"WITH {LEDGER}, {VENDOR}, {FILLED}, miss AS (SELECT {HASH_ALL} AS h FROM filled f WHERE {MISS32}) "
    f"SELECT * FROM filled WHERE {HASH_ALL} NOT IN (SELECT h FROM miss)")
ORACLES["overlay_by_fingerprint"] = f"{XREF} SELECT {_annot_cols('miss31', None)} FROM flags"

# --------------------------------------------------------------- row ids ---
LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORACLES["row_ids"] = (
    f"SELECT {', '.join(LI_COLS)}, '{RUN}_' || CAST(row_number() OVER (ORDER BY {order_all(LI_COLS)}) "
    "AS VARCHAR) AS row_id FROM lineitem")

# ---------------------------------------------------------------- files ---
EXTRACT_COLS = [c for c in LEDGER_COLS if c != "file_name"]
ORACLES["scan_delimited"] = (
    f"WITH {LEDGER} SELECT {', '.join(EXTRACT_COLS)}, 'São Paulo' AS city FROM ledger")
ORACLES["ingest_files"] = (
    f"WITH {LEDGER} SELECT {', '.join(EXTRACT_COLS)}, 'São Paulo' AS city, file_name FROM ledger")
_LINE = "array_to_string([" + ", ".join(f"coalesce({c}, '')" for c in EXTRACT_COLS) + "], chr(9))"
ORACLES["scan_malformed"] = (
    f"WITH {LEDGER}, n AS (SELECT *, CAST(doc_number AS BIGINT) AS n FROM ledger) "
    "SELECT n % 13 = 0 OR n % 17 = 0 AS malformed, "
    f"CASE WHEN n % 13 = 0 THEN {_LINE} || chr(9) || 'more' WHEN n % 17 = 0 THEN 'less' || chr(9) || doc_number "
    "ELSE doc_number END AS line FROM n")
ORACLES["scan_by_spec"] = ORACLES["ingest_files"]
NAMES = ("names AS (SELECT o_orderkey AS file_id, "
         "(CASE WHEN o_orderkey % 13 = 0 THEN 'other_' ELSE 'ledger_' END) || "
         "(CASE WHEN o_orderkey % 11 = 0 THEN '20241301' ELSE strftime(o_orderdate, '%Y%m%d') END) || '_' || "
         "lpad(CAST((o_custkey * 167) % 300000 AS VARCHAR), 6, '0') || "
         "(CASE WHEN o_orderkey % 17 = 0 THEN '_x' ELSE '' END) || "
         "(CASE WHEN o_orderkey % 7 = 0 THEN '.csv' ELSE '.txt' END) AS file_name FROM orders)")
ORACLES["ingest_mixed"] = (
    f"WITH {LEDGER} SELECT {', '.join(EXTRACT_COLS)}, 'São Paulo' AS city, "
    f"CASE WHEN file_name IN {SECOND} THEN replace(file_name, '.txt', '.psv') ELSE file_name END AS file_name, "
    f"CASE WHEN file_name IN {SECOND} THEN 'pipe' ELSE 'tab' END AS source FROM ledger")
# a line of one-byte characters, its city and two more bytes: a tab and the line end
ORACLES["file_listing"] = (
    f"WITH {LEDGER} SELECT file_name, CAST(sum(length({_LINE}) + length('São Paulo') + 2) AS BIGINT) AS bytes "
    "FROM ledger GROUP BY file_name")
ORACLES["file_select"] = (
    f"WITH {NAMES} SELECT file_id, file_name FROM names "
    "WHERE starts_with(lower(file_name), 'ledger') AND ends_with(lower(file_name), '.txt')")
_STEM = "split_part(lower(file_name), '.', 1)"
_EXT = "CASE WHEN strpos(file_name, '.') > 0 THEN substr(lower(file_name), strpos(file_name, '.') + 1) ELSE '' END"
ORACLES["filename_mask"] = (
    f"WITH {NAMES} SELECT file_id, file_name, coalesce("
    f"starts_with({_STEM}, 'ledger_') AND regexp_full_match({_STEM}, 'ledger_[^_]{{8}}_[^_]{{6}}(_.*)?') "
    f"AND try_strptime(regexp_extract({_STEM}, '^ledger_([^_]{{8}})', 1), '%Y%m%d') IS NOT NULL "
    f"AND try_strptime(regexp_extract({_STEM}, '^ledger_[^_]{{8}}_([^_]{{6}})', 1), '%H%M%S') IS NOT NULL "
    f"AND {_EXT} = 'txt', FALSE) AS mask_ok FROM names")

# -------------------------------------------------------------- schemas ---
_DATE = "CAST(try_strptime({c}, '%Y%m%d') AS DATE)"
_INT = "CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN CAST(trim({c}) AS INTEGER) END"
_DEC = "try_cast({c} AS DECIMAL(25,5))"
_TYPED = {"posting_date": _DATE, "entry_date": _DATE, "doc_line": _INT, "amount_lc": _DEC}
_REQUIRED = ["source_system", "company_code", "posting_date"]


def _conform() -> str:
    sel, probs = [], []
    for c in LEDGER_COLS[:-1]:
        conv = _TYPED.get(c, "{c}").format(c=c)
        sel.append(f"{conv} AS {c}")
        if c in _TYPED:
            probs.append(f"CASE WHEN {c} IS NOT NULL AND {conv} IS NULL THEN '{c}' END")
        if c in _REQUIRED:
            probs.append(f"CASE WHEN {conv} IS NULL AND {c} IS NULL THEN '{c}' END")
    sel += ["file_name", "CAST(NULL AS VARCHAR) AS row_id"]
    return (f"WITH {LEDGER} SELECT {', '.join(sel)}, concat_ws(',', {', '.join(probs)}) AS conform_errors "
            "FROM ledger")


ORACLES["conform_typed"] = _conform()
ORACLES["apply_defaults"] = (
    f"WITH {LEDGER} SELECT doc_number, company_code, amount_lc, file_name, 'A' AS sys_status_code, "
    "'MANUAL INSERT' AS sys_created_by_name, CAST(0 AS INTEGER) AS reject_all, "
    "TIMESTAMP '2024-01-01 00:00:00' AS sys_created_on FROM ledger")
ORACLES["insert_defaults"] = ORACLES["apply_defaults"]
ORACLES["register_location"] = (
    f"WITH {LEDGER}, {HL} SELECT doc_number, vendor_code, posting_month FROM hl WHERE posting_month >= '199501'")
ORACLES["reload_table"] = (
    f"WITH {VENDOR} SELECT lower(a.vendor_id) AS vendor_id, a.company_code, b.vendor_id AS was "
    "FROM mv a JOIN mv b ON lower(a.vendor_id) = lower(b.vendor_id)")


def _wall(instant: str, zone: str) -> str:
    return f"(({instant}) AT TIME ZONE 'UTC' AT TIME ZONE '{zone}')"


_NY = [_wall(f"ts + INTERVAL ({h}) HOUR", "America/New_York") for h in (-1, 0, 1)]
ORACLES["stamp_zone"] = (
    f"SELECT event_id, {_wall('ts', 'America/Sao_Paulo')} AS sao_paulo, {_NY[1]} AS new_york, "
    f"{_wall('ts', 'Asia/Kolkata')} AS kolkata, {_NY[0]} = {_NY[1]} OR {_NY[2]} = {_NY[1]} AS twice, "
    f"CASE WHEN {_NY[0]} = {_NY[1]} THEN ts - INTERVAL 1 HOUR ELSE ts END AS earlier, "
    f"CASE WHEN {_NY[2]} = {_NY[1]} THEN ts + INTERVAL 1 HOUR ELSE ts END AS later FROM events")
ORACLES["align_schema"] = (
    f"WITH {LEDGER} SELECT source_system, company_code, posting_date, doc_type, doc_number, doc_line, "
    "entry_date, amount_lc, CAST(NULL AS VARCHAR) AS vendor_code, file_name, "
    "CAST(NULL AS VARCHAR) AS row_id FROM ledger")

# ------------------------------------------------------------ run ledger ---
PROCS = ("procs AS (SELECT DISTINCT user_id AS process_id, 'Finance ' || CAST(user_id % 5 AS VARCHAR) "
         "AS process_name, CASE user_id % 3 WHEN 0 THEN 'RAW TO BRONZE' WHEN 1 THEN 'BRONZE TO SILVER' "
         "ELSE 'SP TO S3' END AS step_name, 'SAP' || CAST(user_id % 2 AS VARCHAR) AS source_system, "
         "CASE WHEN user_id % 7 = 0 THEN 'I' ELSE 'A' END AS status FROM events)")
ORACLES["process_lookup"] = (
    f"WITH {PROCS} SELECT * FROM procs WHERE lower(process_name) = 'finance 1' AND "
    "lower(step_name) = 'raw to bronze' AND lower(source_system) = 'sap1' AND status = 'A' "
    "ORDER BY process_id LIMIT 1")
ORACLES["process_lookup_ilike"] = (
    f"WITH {PROCS} SELECT * FROM procs WHERE process_name ILIKE 'FINANCE _' AND step_name ILIKE 'raw%BRONZE' "
    "AND source_system ILIKE 'sap1' AND status = 'A' ORDER BY process_id LIMIT 1")
ORACLES["run_start_ids"] = (
    f"WITH {PROCS} SELECT process_id, process_name, step_name, CAST((SELECT max(event_id) FROM events) + "
    "row_number() OVER (ORDER BY process_id) AS BIGINT) AS run_id FROM procs WHERE status = 'A'")
RULES_PH = ("rules AS (SELECT * FROM (VALUES "
            "(11, 2, 'doc_line', 'not_null', NULL, 0, NULL), "
            "(12, 2, 'doc_line', 'numeric_format', 'integer', 0, NULL), "
            "(13, 2, 'amount_lc', 'numeric_format', 'decimal(15,5)', 0, NULL), "
            "(21, 2, 'source_system', 'not_null', NULL, 1, NULL), "
            "(22, 2, 'posting_date', 'date_format', 'yyyyMMdd', 1, NULL), "
            "(23, 2, 'doc_number', 'out_of_range', '> ''0''', 1, NULL), "
            "(24, 2, 'doc_number', 'conditional_fail', 'doc_type = ''XX'' OR company_code = ''C99''', 1, NULL), "
            "(14, 2, 'doc_line', 'out_of_range', '< ''7''', 0, NULL), "
            "(15, 2, 'vendor_code', 'conditional_fail', 'doc_type = ''RF'' AND vendor_code IS NULL', 0, NULL)"
            ") AS t(rule_id, process_id, column_name, rule_code, rule_detail, reject_all, master_table))")
ORACLES["active_rules"] = (
    f"WITH {RULES_PH} SELECT e.event_id AS run_id, CAST(r.rule_id AS BIGINT) AS rule_id, r.column_name, "
    "r.rule_code, r.rule_detail, CAST(r.reject_all AS INTEGER) AS reject_all, "
    "CAST(r.master_table AS VARCHAR) AS master_table "
    "FROM events e JOIN rules r ON e.user_id = r.process_id")
ORACLES["run_start"] = "SELECT event_id AS run_id, user_id AS process_id, ts AS start_ts FROM events"
ORACLES["run_last"] = "SELECT user_id AS process_id, max(event_id) AS last_run_id FROM events GROUP BY 1"
ORACLES["run_last_flag"] = (
    "SELECT event_id AS run_id, user_id AS process_id, ts AS start_ts, "
    "CAST(CASE WHEN event_id = max(event_id) OVER (PARTITION BY user_id) THEN 1 ELSE 0 END AS INTEGER) "
    "AS last_flag FROM events")
ORACLES["run_state"] = (
    "SELECT event_id AS run_id, user_id AS process_id, ts AS start_ts, "
    "CASE WHEN event_type <> 'error' THEN ts + INTERVAL 1 MINUTE END AS end_ts, "
    "CASE WHEN event_type <> 'error' THEN 'C' ELSE 'E' END AS status, "
    "CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS source_count FROM events")
ORACLES["process_parameters"] = (
    "SELECT DISTINCT user_id AS process_id, 'Finance ' || CAST(user_id AS VARCHAR) AS process_name, "
    "'RAW TO BRONZE' AS step_name, 'SAP0' AS source_system, 'A' AS status, 'ledger' AS file_prefix, "
    "'txt' AS file_extension, '{fileName}_{yyyymmdd}_{hhmmss}.{fileExtension}' AS file_mask, "
    "chr(9) AS file_delimiter, 'ledger-raw' AS schema_name FROM events WHERE user_id = 2")
ORACLES["run_metrics"] = (
    f"WITH {LEDGER}, {_EVAL_FILE}, c AS (SELECT {_RUN} AS run_id, count(*) AS src, "
    "count(*) FILTER (WHERE reject_reasons = '') AS tgt FROM ev GROUP BY file_name) "
    "SELECT CAST(run_id AS BIGINT) AS run_id, CAST(2 AS BIGINT) AS process_id, 10 AS seq, 'SET' AS event, "
    f"'source_record_count' AS attr, CAST(src AS VARCHAR) AS value, {T3} AS event_ts FROM c UNION ALL "
    "SELECT CAST(run_id AS BIGINT), CAST(2 AS BIGINT), 11, 'SET', 'target_record_count', "
    f"CAST(tgt AS VARCHAR), {T3} FROM c")

# ------------------------------------------------------------ pipelines ---
ORACLES["bronze_load"] = (
    f"WITH {LEDGER}, {_EVAL_FILE} SELECT CASE WHEN reject_reasons = '' THEN 'bronze' "
    "ELSE 'bronze_rejected' END AS target, file_name, reject_reasons, CAST(count(*) AS BIGINT) AS rows "
    "FROM ev GROUP BY 1, 2, 3")


def silver_flags(tag: str, where: str = "TRUE", number: int = 0) -> str:
    """CTEs of one silver load over the accepted rows of some extracts, down to
    flags<tag>; ``number`` is the run of the row ids."""
    ids = ", ".join(f"{c} ASC NULLS FIRST" for c in [*EXTRACT_COLS, "file_name", "posting_month"])
    numbered = f", '{number}_' || CAST(row_number() OVER (ORDER BY {ids}) AS VARCHAR) AS row_id"
    return (
        f"acc{tag} AS (SELECT {', '.join(LEDGER_COLS)}, {MONTH_EXPR} AS posting_month "
        f"FROM ev WHERE reject_reasons = '' AND {where}), "
        f"lf{tag} AS (SELECT posting_month AS m, max(file_name) AS f FROM acc{tag} GROUP BY 1), "
        f"lat{tag} AS (SELECT acc{tag}.*{numbered} FROM acc{tag} JOIN lf{tag} ON posting_month = m AND file_name = f), "
        f"filled{tag} AS (SELECT " + ", ".join(f"coalesce({c}, 'UNSP') AS {c}" for c in LEDGER_COLS)
        + f", posting_month, row_id FROM lat{tag}), "
        f"flags{tag} AS (SELECT f.*, {MISS32} AS miss32, {MISS31} AS miss31 FROM filled{tag} f)")


_SILVER_SRC = f"WITH {LEDGER}, {_EVAL_FILE}, {VENDOR}, {COMPANY}, {silver_flags('')}"
ORACLES["silver_load"] = (
    f"{_SILVER_SRC} SELECT {_annot_cols('(miss32 OR miss31)', 'miss32')}, posting_month FROM flags")
ORACLES["load_by_process"] = ORACLES["silver_load"]
ORACLES["silver_load_with_rejects"] = (
    f"{_SILVER_SRC}, xev AS (SELECT *, {xref_reasons()} FROM flags) "
    f"SELECT CASE WHEN reject_reasons = '' THEN 'silver' ELSE 'silver_rejected' END AS target, "
    f"{', '.join(LEDGER_COLS)}, posting_month, reject_reasons, error_value FROM xev")
ORACLES["rejected_history"] = (
    f"WITH {LEDGER}, {_EVAL_FILE} "
    f"SELECT ev.*, {MONTH_EXPR} AS posting_month, CASE WHEN file_name IN {FIRST} THEN {T1} ELSE {T2} END AS valid_from, "
    f"CASE WHEN file_name IN {FIRST} THEN {T2} ELSE {NULL_TS} END AS valid_to, "
    f"file_name IN {SECOND} AS is_current FROM ev WHERE reject_reasons <> ''")
ORACLES["history_first_load"] = ORACLES["scd_derived_validity"]

# ------------------------------------------------------------ second runs ---
_BRONZE_RUN = f"CASE WHEN file_name IN {FIRST} THEN 1 ELSE 3 END"
_BRONZE_IDS = (
    f"bev AS (SELECT ev.*, {_BRONZE_RUN} AS r, CAST({_BRONZE_RUN} AS VARCHAR) || '_' || CAST(row_number() OVER ("
    f"PARTITION BY {_BRONZE_RUN} ORDER BY file_name, {order_all(EXTRACT_COLS)}) AS VARCHAR) AS row_id FROM ev)")
ORACLES["bronze_reload"] = (
    f"WITH {LEDGER}, {_EVAL_FILE}, {_BRONZE_IDS}, "
    "t AS (SELECT *, CASE WHEN reject_reasons = '' THEN 'bronze' ELSE 'bronze_rejected' END AS target FROM bev), "
    # a run supersedes the table where a later run wrote rows to it
    "later AS (SELECT DISTINCT target AS lt FROM t WHERE r = 3) "
    f"SELECT target, row_id, {', '.join(LEDGER_COLS)}, reject_reasons, {stamp_of('r')} AS valid_from, "
    f"CASE WHEN r = 1 AND target IN (SELECT lt FROM later) THEN {T3} ELSE {NULL_TS} END AS valid_to, "
    "NOT (r = 1 AND target IN (SELECT lt FROM later)) AS is_current, CAST(r AS BIGINT) AS run_id FROM t")
_TWO = (f"WITH {LEDGER}, {_EVAL_FILE}, {VENDOR}, {COMPANY}, {silver_flags('2', f'file_name IN {FIRST}', 2)}, "
        f"{silver_flags('4', f'file_name IN {SECOND}', 4)}, "
        "runs AS (SELECT *, 2 AS r FROM flags2 UNION ALL SELECT *, 4 AS r FROM flags4)")


def _until(later: str) -> str:
    return f"CASE WHEN r = 2 AND posting_month IN (SELECT posting_month FROM {later}) THEN {T4} ELSE {NULL_TS} END"


def _history(to: str) -> str:
    return f"{stamp_of('r')} AS valid_from, {to} AS valid_to, {to} IS NULL AS is_current, CAST(r AS BIGINT) AS run_id"


ORACLES["silver_reload"] = (
    f"{_TWO} SELECT row_id, {_annot_cols('(miss32 OR miss31)', 'miss32')}, posting_month, {_history(_until('flags4'))} "
    "FROM runs")
_BAD_TO = f"CASE WHEN r = 2 AND EXISTS (SELECT 1 FROM xev WHERE r = 4 AND reject_reasons <> '') THEN {T4} ELSE {NULL_TS} END"
ORACLES["silver_rejects_reload"] = (
    f"{_TWO}, xev AS (SELECT *, {xref_reasons()} FROM runs), "
    "ok4 AS (SELECT DISTINCT posting_month FROM xev WHERE r = 4 AND reject_reasons = '') "
    f"SELECT 'silver' AS target, {', '.join(LEDGER_COLS)}, posting_month, {_history(_until('ok4'))}, "
    "reject_reasons, error_value FROM xev WHERE reject_reasons = '' UNION ALL "
    f"SELECT 'silver_rejected', {', '.join(LEDGER_COLS)}, posting_month, {_history(_BAD_TO)}, "
    "reject_reasons, error_value FROM xev WHERE reject_reasons <> ''")
_BRONZE_GATED = f"{_BRONZE_IDS}, bg AS (SELECT bev.*, gate.g AS g FROM bev JOIN gate ON file_name = gf)"
ORACLES["load_error_log"] = (
    f"{_TWO}, {_BRONZE_GATED}, logged AS ({log_rows('(SELECT * FROM bg WHERE r = 1)', 1)} UNION ALL "
    f"{log_rows('(SELECT * FROM bg WHERE r = 3)', 3)} UNION ALL {xref_log('flags2', 2)} UNION ALL {xref_log('flags4', 4)}) "
    "SELECT *, 'ledger' AS object_name FROM logged")
_NULL_MONTHS = "(SELECT count(*) FROM acc{t} WHERE posting_month IS NULL)"
ORACLES["load_run_state"] = (
    f"{_TWO}, {_BRONZE_IDS}, "
    "c AS (SELECT r, count(*) AS src, count(*) FILTER (WHERE reject_reasons = '') AS tgt, NULL AS nm FROM bev GROUP BY r "
    "UNION ALL " + " UNION ALL ".join(
        f"SELECT {t}, count(*), count(*) FILTER (WHERE NOT miss31 AND NOT miss32), "
        f"{_NULL_MONTHS.format(t=t)} FROM flags{t}" for t in (2, 4)) + ") "
    f"SELECT CAST(r AS BIGINT) AS run_id, CAST(CASE WHEN r % 2 = 1 THEN 2 ELSE 3 END AS BIGINT) AS process_id, "
    f"{stamp_of('r')} AS start_ts, {stamp_of('r')} AS end_ts, 'C' AS status, CAST(src AS VARCHAR) AS source_record_count, "
    "CAST(tgt AS VARCHAR) AS target_record_count, CAST(nm AS VARCHAR) AS null_month_rows FROM c")
