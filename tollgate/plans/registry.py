"""Registered queries: one per operator of the inventory, each a DataFrame
built from the test tables under ``sf_dir``.

Every query reads whole tables; nothing is sampled, filtered or capped.  Rule tables,
masters and fixed ``as_of`` stamps are passed explicitly so results are
reproducible.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions import rules as R
from tollgate.operators import quality as Q
from tollgate.operators.rowids import row_ids
from tollgate.session import checkpoint_dir
from tollgate.sources import testdata as TD
from tollgate.sources.history_store import HistoryStore, TypeChange
from tollgate.sources.scoped_table import ScopedTable
from tollgate.staging import staged_path, unstage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


# Run id used for row ids and error logs of the fixture loads.
FIXTURE_RUN_ID = 7


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _outcomes(df: DataFrame, rules: list[R.Rule], keep: list[str]) -> DataFrame:
    return Q.rule_outcomes(df, rules, keep)


def _pick(ids: list[int], rules: list[R.Rule] | None = None) -> list[R.Rule]:
    pool = rules or R.ledger_rule_list(R.PHYSICAL, active_only=False)
    by_id = {r.rule_id: r for r in pool}
    return [by_id[i] for i in ids]


# ---------------------------------------------------------------- rules ---

@query("rule_not_null")
def q_rule_not_null(spark, d):
    return _outcomes(TD.ledger(spark, d), _pick([11, 21]),
                     ["doc_number", "posting_date", "source_system", "doc_line"])


@query("rule_date_format")
def q_rule_date_format(spark, d):
    return _outcomes(TD.ledger(spark, d), _pick([22]), ["doc_number", "posting_date"])


@query("rule_numeric_format")
def q_rule_numeric_format(spark, d):
    return _outcomes(TD.ledger(spark, d), _pick([12, 13]), ["doc_number", "amount_lc", "doc_line"])


@query("rule_out_of_range")
def q_rule_out_of_range(spark, d):
    return _outcomes(TD.ledger(spark, d), _pick([14, 16, 23]),
                     ["doc_number", "posting_date", "entry_date", "doc_line"])


@query("rule_conditional_fail")
def q_rule_conditional_fail(spark, d):
    return _outcomes(TD.ledger(spark, d), _pick([15, 24]),
                     ["doc_number", "doc_type", "vendor_code", "company_code"])


# Extra rules that exercise unknown codes and NULL outcomes.
EXTRA_RULES = [
    R.Rule(91, "vendor_code", "no_such_rule", "anything"),
    R.Rule(92, "doc_type", R.OUT_OF_RANGE, "< vendor_code"),
    R.Rule(93, "doc_line", R.CONDITIONAL_FAIL, "doc_line > '5'"),
]


@query("rule_unknown_passes")
def q_rule_unknown_passes(spark, d):
    return _outcomes(TD.ledger(spark, d), [EXTRA_RULES[0]], ["doc_number", "vendor_code"])


@query("rule_null_semantics")
def q_rule_null_semantics(spark, d):
    return _outcomes(TD.ledger(spark, d), EXTRA_RULES[1:],
                     ["doc_number", "doc_type", "vendor_code", "doc_line"])


# -------------------------------------------------------- gate and rows ---

def _physical_rules() -> list[R.Rule]:
    return R.ledger_rule_list(R.PHYSICAL)


def _evaluated(spark, d) -> DataFrame:
    """The whole ledger, every extract a batch of its own."""
    return Q.evaluate(TD.ledger(spark, d), _physical_rules(), batch_key="file_name")


@query("row_rules")
def q_row_rules(spark, d):
    return _evaluated(spark, d)


@query("accepted_rows")
def q_accepted_rows(spark, d):
    return Q.accepted(_evaluated(spark, d))


@query("rejected_rows")
def q_rejected_rows(spark, d):
    return Q.rejected(_evaluated(spark, d))


@query("error_log")
def q_error_log(spark, d):
    ids = row_ids(TD.ledger(spark, d), FIXTURE_RUN_ID)
    return Q.error_log(ids, _physical_rules(), FIXTURE_RUN_ID, batch_key="file_name")


@query("rule_fail_counts")
def q_rule_fail_counts(spark, d):
    return Q.rule_fail_counts(TD.ledger(spark, d), _physical_rules())


@query("route_counts")
def q_route_counts(spark, d):
    return Q.route_counts(_evaluated(spark, d), ["file_name"])


@query("gate_decision")
def q_gate_decision(spark, d):
    g = Q.gate_table(TD.ledger(spark, d), _physical_rules(), "file_name")
    return g.select("file_name", F.col(Q.GATE).alias("failed_rules"),
                    (F.col(Q.GATE) == "").alias("passed"))


@query("gate_reject_all")
def q_gate_reject_all(spark, d):
    return _evaluated(spark, d).groupBy("file_name", Q.REASONS).agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


@query("gate_whole_batch")
def q_gate_whole_batch(spark, d):
    ev = Q.evaluate(TD.ledger(spark, d), _physical_rules())
    return ev.groupBy(Q.REASONS).agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


# ------------------------------------------------------------- versions ---

from tollgate.operators import history as H  # noqa: E402
from tollgate.operators import versions as V  # noqa: E402

# Load stamps of the four fixture runs.
STAMPS = ["2024-01-01 09:00:00", "2024-01-02 09:00:00", "2024-01-03 09:00:00", "2024-01-04 09:00:00"]
T1, T2, T3, T4 = STAMPS
# Two deliveries of two extracts each.
FIRST, SECOND = TD.LEDGER_FILES[:2], TD.LEDGER_FILES[2:]


def months(spark: SparkSession, d: str) -> DataFrame:
    return V.with_month(TD.ledger(spark, d))


def file_rows(spark: SparkSession, d: str, *names: str) -> DataFrame:
    return months(spark, d).filter(F.col("file_name").isin(*names))


@query("month_key")
def q_month_key(spark, d):
    return V.with_month(TD.ledger(spark, d)).select("doc_number", "posting_date", V.MONTH)


@query("latest_file_per_month")
def q_latest_file_per_month(spark, d):
    return V.latest_file_per_month(months(spark, d))


@query("latest_version")
def q_latest_version(spark, d):
    return V.latest_version(months(spark, d), month_domain=True)


@query("reprocess_scope")
def q_reprocess_scope(spark, d):
    h1 = H.stamp_history(file_rows(spark, d, *FIRST), T1)
    return V.reprocess_scope(H.current_rows(h1), file_rows(spark, d, *SECOND))


# -------------------------------------------------------------- history ---

@query("stamp_history")
def q_stamp_history(spark, d):
    return H.stamp_history(months(spark, d), T1)


@query("scd_expire_all")
def q_scd_expire_all(spark, d):
    h1 = H.stamp_history(file_rows(spark, d, *FIRST), T1)
    return H.append_merge_schema(H.expire_all(h1, T2),
                                 H.stamp_history(file_rows(spark, d, *SECOND), T2))


@query("scd_expire_scope")
def q_scd_expire_scope(spark, d):
    h1 = H.stamp_history(file_rows(spark, d, *FIRST), T1)
    scope = V.reprocess_scope(h1, file_rows(spark, d, *SECOND))
    return H.expire_scope(h1, scope, [V.MONTH], T2)


def _silver_history(spark, d) -> DataFrame:
    """Four loads in a row; each load's history is materialised (Parquet in
    the shared folder), as a stored table would be between runs, so the next
    load does not recompute the earlier ones.  The history that a load has
    replaced is removed."""
    h, kept = H.stamp_history(file_rows(spark, d, TD.FILE_1), T1), []
    for name, stamp in zip(TD.LEDGER_FILES[1:], STAMPS[1:]):
        path = staged_path(spark, "silver")
        h.write.parquet(path)
        unstage(spark, *kept)
        h, kept = spark.read.schema(h.schema).parquet(path), [path]
        h = H.expire_and_append(h, file_rows(spark, d, name), [V.MONTH], stamp, month_domain=True)
    return h


@query("scd_expire_append")
def q_scd_expire_append(spark, d):
    return _silver_history(spark, d)


@query("current_rows")
def q_current_rows(spark, d):
    return H.current_rows(_silver_history(spark, d))


HISTORY_FIELDS = [T.StructField(H.VALID_FROM, T.TimestampNTZType()), T.StructField(H.VALID_TO, T.TimestampNTZType()),
                  T.StructField(H.CURRENT, T.BooleanType())]


def _month_table(spark, rows: DataFrame) -> ScopedTable:
    return ScopedTable(spark, scratch(spark, "months"), [V.MONTH], T.StructType([*rows.schema.fields, *HISTORY_FIELDS]))


@query("scd_expire_rewrite")
def q_scd_expire_rewrite(spark, d):
    """The stored table: only the folders of the expired months are rewritten."""
    h1 = file_rows(spark, d, *FIRST)
    table = _month_table(spark, h1)
    table.reload(h1, T1)
    table.expire(file_rows(spark, d, *SECOND), T2)
    return table.read()


@query("scd_reload_rewrite")
def q_scd_reload_rewrite(spark, d):
    """Four loads into the stored table, each one rewrite of its months."""
    table = _month_table(spark, months(spark, d))
    for name, stamp in zip(TD.LEDGER_FILES, STAMPS):
        table.reload(file_rows(spark, d, name), stamp)
    return table.read()


@query("scd_derived_validity")
def q_scd_derived_validity(spark, d):
    # The runs' appended rows, read in one scan: run and stamp follow the file.
    number = F.array_position(F.array(*[F.lit(n) for n in TD.LEDGER_FILES]), F.col("file_name"))
    stamp = F.element_at(F.array(*[F.lit(t) for t in STAMPS]), number.cast("int"))
    rows = months(spark, d).select("*", number.cast("bigint").alias(H.RUN), H.as_timestamp(stamp).alias(H.VALID_FROM))
    return H.derive_validity(rows, [V.MONTH])


@query("history_type_change")
def q_history_type_change(spark, d):
    """Four runs whose columns widen, narrow and appear; one run is refused."""
    store = HistoryStore(spark, scratch(spark, "history"), [V.MONTH])
    layouts = [
        {"doc_number": "int", "doc_line": "int", "amount_lc": "decimal(15,2)"},
        {"doc_number": "bigint", "doc_line": "smallint", "amount_lc": "decimal(20,4)"},
        {"doc_number": "int", "amount_lc": "decimal(12,2)", "entry_date": "date"},
        {"doc_number": "bigint", "doc_line": "int", "amount_lc": "decimal(12,2)", "entry_date": "timestamp_ntz"}]
    for run, (name, stamp, types) in enumerate(zip(TD.LEDGER_FILES, STAMPS, layouts), 1):
        rows = file_rows(spark, d, name)
        day = F.to_date("entry_date", "yyyyMMdd")
        store.append(rows.select("file_name", V.MONTH, *[
            (day if c == "entry_date" else F.col(c)).try_cast(t).alias(c) for c, t in types.items()]), run, stamp)
    try:
        store.append(file_rows(spark, d, TD.FILE_1).select("file_name", V.MONTH, "doc_line"), 9, T4)
    except TypeChange:
        return store.read()
    raise AssertionError("text went into a number column")


@query("append_merge_schema")
def q_append_merge_schema(spark, d):
    a = file_rows(spark, d, *FIRST).select(
        "source_system", "company_code", "posting_date", "doc_type", "doc_number", "file_name")
    b = file_rows(spark, d, *SECOND).select(
        "doc_number", "doc_line", "amount_lc", "vendor_code", "file_name",
        F.concat(F.lit("note-"), F.col("doc_type")).alias("extra_note"))
    return H.append_merge_schema(a, b)


# ----------------------------------------------------------- references ---

from tollgate.functions.columns import fill_sentinel, fingerprint, lookup_marker  # noqa: E402
from tollgate.operators import fingerprint as FP  # noqa: E402
from tollgate.operators import references as X  # noqa: E402


def _business_rules() -> list[R.Rule]:
    return R.ledger_rule_list(R.BUSINESS)


def _resolver(spark, d) -> X.MasterResolver:
    return X.mapping_resolver(TD.masters(spark, d))


@query("fill_sentinel")
def q_fill_sentinel(spark, d):
    return fill_sentinel(TD.ledger(spark, d))


@query("xref_anti")
def q_xref_anti(spark, d):
    return X.anti(TD.ledger(spark, d), _business_rules()[1], _resolver(spark, d))


@query("xref_annotate")
def q_xref_annotate(spark, d):
    return X.annotate(TD.ledger(spark, d), _business_rules(), _resolver(spark, d))


@query("xref_error_log")
def q_xref_error_log(spark, d):
    ids = row_ids(TD.ledger(spark, d), FIXTURE_RUN_ID)
    return X.error_log(ids, _business_rules(), _resolver(spark, d), FIXTURE_RUN_ID)


@query("xref_reject")
def q_xref_reject(spark, d):
    return X.reject(TD.ledger(spark, d), _business_rules(), _resolver(spark, d))


@query("xref_accept")
def q_xref_accept(spark, d):
    return X.accept(TD.ledger(spark, d), _business_rules(), _resolver(spark, d))


@query("xref_missing_master")
def q_xref_missing_master(spark, d):
    absent = R.Rule(95, "vendor_code", R.CROSS_REFERENCE, None, master_table="master_absent",
                    keys=(("vendor_code", "vendor_id"),))
    return X.annotate(TD.ledger(spark, d), [absent, _business_rules()[0]], _resolver(spark, d))


@query("xref_miss_matrix")
def q_xref_miss_matrix(spark, d):
    return X.miss_matrix(TD.ledger(spark, d), _business_rules(), _resolver(spark, d))


# ---------------------------------------------------------- fingerprint ---

@query("row_fingerprint")
def q_row_fingerprint(spark, d):
    return FP.with_fingerprint(fill_sentinel(TD.ledger(spark, d)))


@query("fingerprint_anti")
def q_fingerprint_anti(spark, d):
    led = fill_sentinel(TD.ledger(spark, d))
    missed = X.anti(TD.ledger(spark, d), _business_rules()[1], _resolver(spark, d))
    return FP.fingerprint_anti(led, missed)


@query("overlay_by_fingerprint")
def q_overlay_by_fingerprint(spark, d):
    led = fill_sentinel(TD.ledger(spark, d))
    rule = _business_rules()[0]
    missed = X.anti(TD.ledger(spark, d), rule, _resolver(spark, d))
    marked = FP.with_fingerprint(missed, led.columns).withColumn(
        "company_code", lookup_marker("company_code"))
    return FP.overlay_by_fingerprint(led, marked)


# --------------------------------------------------------------- row ids ---

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"]


@query("row_ids")
def q_row_ids(spark, d):
    return row_ids(TD.table(spark, d, "lineitem"), FIXTURE_RUN_ID, order_cols=LINEITEM_COLS)


# ---------------------------------------------------------------- files ---

from tollgate.functions.filenames import mask_predicate  # noqa: E402
from tollgate.sources import delimited as DL  # noqa: E402
from tollgate.sources import listing as LS  # noqa: E402
from tollgate.sources import mixed as MX  # noqa: E402

# Accented constant proving Latin-1 decoding; mask of the extracts.
CITY = "São Paulo"
EXTRACT_MASK = "{fileName}_{yyyymmdd}_{hhmmss}.{fileExtension}"
EXTRACT_COLS = [c for c in TD.LEDGER_COLUMNS if c != "file_name"] + ["city"]


# Rows of a part file at most: a large extract comes in several.
PART_ROWS = 100_000


def write_landing(spark: SparkSession, d: str, spec: DL.ReaderSpec = DL.ReaderSpec(),
                  source: DataFrame | None = None) -> str:
    """The folder of the ledger (or ``source``) as delimited extracts, one
    entry per file name, plus a decoy extract that selection must skip: all
    rows once more, as compressed parts.  It is removed when the driver ends.

    One write deals the rows into the extracts as they come from their source,
    with no shuffle and no copy in between; the decoy copies their lines."""
    root = staged_path(spark, "landing")
    rows = TD.ledger(spark, d) if source is None else source
    dealt = f"{root}/dealt"
    DL.write_delimited(rows.withColumn("city", F.lit(CITY)).select(*EXTRACT_COLS, "file_name"), dealt, spec,
                       by=["file_name"], part_rows=PART_ROWS)
    names = DL.undeal(spark, dealt, root, "file_name")
    decoy = f"{root}/other_20240101_120000.csv"
    if names:
        lines = spark.read.text([f"{root}/{n}" for n in names])
        lines.write.option("compression", "gzip").text(decoy)
    else:
        DL.write_delimited(spark.createDataFrame([], DL.text_schema(EXTRACT_COLS)), decoy, spec)
    return root


@query("scan_delimited")
def q_scan_delimited(spark, d):
    root = write_landing(spark, d)
    return DL.scan_delimited(spark, [f"{root}/{n}" for n in TD.LEDGER_FILES], EXTRACT_COLS)


@query("scan_malformed")
def q_scan_malformed(spark, d):
    """Lines with a field too many or too few keep their text."""
    led = TD.ledger(spark, d)
    number = F.col("doc_number").cast("bigint")
    whole = F.array_join(F.array(*[F.coalesce(c, F.lit("")) for c in EXTRACT_COLS[:-1]]), "\t")
    line = F.when(number % 13 == 0, F.concat(whole, F.lit("\tmore"))).when(
        number % 17 == 0, F.concat(F.lit("less\t"), F.col("doc_number"))).otherwise(whole)
    path = f"{scratch(spark, 'lines')}/ledger.txt"
    led.select(line.alias("value")).write.text(path)
    found = DL.scan_delimited(spark, path, EXTRACT_COLS[:-1], flag_malformed=True)
    return found.select(F.col(DL.CORRUPT).isNotNull().alias("malformed"),
                        F.coalesce(DL.CORRUPT, "doc_number").alias("line"))


@query("ingest_files")
def q_ingest_files(spark, d):
    root = write_landing(spark, d)
    return DL.ingest(spark, root, EXTRACT_COLS, DL.ReaderSpec(prefix="ledger", extension="TXT"))


# A process-table row carrying the reader settings.
PROCESS_READER_ROW = {"file_delimiter": "|", "file_encoding": "UTF-8", "file_header": False,
                      "file_extension": "txt", "file_prefix": "LEDGER", "file_mask": EXTRACT_MASK,
                      "schema_name": "ledger-raw"}


@query("scan_by_spec")
def q_scan_by_spec(spark, d):
    spec = DL.ReaderSpec.from_row(PROCESS_READER_ROW)
    root = write_landing(spark, d, spec)
    return DL.ingest(spark, root, EXTRACT_COLS, spec, apply_mask=True)


# Control rows of two sources in one landing folder.
MIXED_ROWS = [
    {"process_name": "tab", "file_delimiter": "\t", "file_encoding": "ISO-8859-1", "file_header": False,
     "file_extension": "txt", "file_prefix": "ledger", "file_mask": EXTRACT_MASK, "schema_name": "ledger"},
    {"process_name": "pipe", "file_delimiter": "|", "file_encoding": "UTF-8", "file_header": True,
     "file_extension": "psv", "file_prefix": "ledger", "file_mask": EXTRACT_MASK, "schema_name": "ledger"}]


@query("ingest_mixed")
def q_ingest_mixed(spark, d):
    """A tab and a pipe delivery with headers, each by its control row."""
    sources = MX.sources_from_control(MIXED_ROWS, lambda name: EXTRACT_COLS)
    root = scratch(spark, "landing")
    led = TD.ledger(spark, d).withColumn("city", F.lit(CITY)).repartition(spark.sparkContext.defaultParallelism).checkpoint()
    for name in TD.LEDGER_FILES:
        source = sources[int(name in SECOND)]
        DL.write_delimited(led.filter(F.col("file_name") == name).select(*EXTRACT_COLS),
                           f"{root}/{name.replace('.txt', '.' + source.spec.extension)}", source.spec)
    return MX.scan_mixed(spark, root, sources)


@query("file_listing")
def q_file_listing(spark, d):
    """The extracts of a landing folder and their bytes, part files included."""
    spec = DL.ReaderSpec(prefix="Ledger", extension="TXT", mask=EXTRACT_MASK)
    return LS.list_extracts(spark, write_landing(spark, d), spec).select("file_name", "bytes")


@query("file_select")
def q_file_select(spark, d):
    return DL.select_files(TD.file_names(spark, d), DL.ReaderSpec(prefix="Ledger", extension="txt"))


@query("filename_mask")
def q_filename_mask(spark, d):
    names = TD.file_names(spark, d)
    return names.select("file_id", "file_name",
                        mask_predicate("file_name", EXTRACT_MASK, "ledger", "txt").alias("mask_ok"))


# -------------------------------------------------------------- schemas ---

from tollgate.functions import zones as Z  # noqa: E402
from tollgate.operators import runs as K  # noqa: E402
from tollgate.sources import catalog as C  # noqa: E402
from tollgate.sources import schemas as S  # noqa: E402
from tollgate.sources import tables as TB  # noqa: E402


@query("conform_typed")
def q_conform_typed(spark, d):
    return S.conform_typed(TD.ledger(spark, d), S.get_schema("ledger-silver"))


# Audit columns with defaults, as a table spec.
AUDIT_SPEC = T.StructType([
    S.field("doc_number", T.StringType(), False, "Document number"),
    S.field("company_code", T.StringType(), True, "Company"),
    S.field("amount_lc", T.StringType(), True, "Amount in local currency"),
    S.field("file_name", T.StringType(), False, "Source extract"),
    S.field("sys_status_code", T.StringType(), False, "Row status", default="'A'"),
    S.field("sys_created_by_name", T.StringType(), False, "Created by", default="'MANUAL INSERT'"),
    S.field("reject_all", T.IntegerType(), False, "Batch rule flag", default="0"),
    S.field("sys_created_on", T.TimestampNTZType(), False, "Created on",
            default="TIMESTAMP_NTZ '2024-01-01 00:00:00'"),
])


@query("apply_defaults")
def q_apply_defaults(spark, d):
    rows = TD.ledger(spark, d).select("file_name", "doc_number", "amount_lc", "company_code")
    return S.apply_defaults(rows, AUDIT_SPEC)


def _table_name(kind: str) -> str:
    return f"tg_{kind}_{uuid.uuid4().hex}"


@query("insert_defaults")
def q_insert_defaults(spark, d):
    """Rows that name four columns, into a catalog table; the table gets its
    last two columns between two inserts."""
    name = _table_name("audit")
    narrow = T.StructType(AUDIT_SPEC.fields[:-2])
    C.create_table(spark, name, narrow, scratch(spark, "table"))
    for spec, files in ((narrow, FIRST), (AUDIT_SPEC, SECOND)):
        C.evolve_table(spark, name, spec)
        rows = TD.ledger(spark, d).filter(F.col("file_name").isin(*files))
        C.insert_rows(rows.select("file_name", "doc_number", "amount_lc", "company_code"), name, spec)
    return spark.table(name)


@query("register_location")
def q_register_location(spark, d):
    """A partitioned folder as a catalog table; new folders are taken up."""
    path, name = scratch(spark, "located"), _table_name("located")
    for names in (FIRST, SECOND):
        rows = file_rows(spark, d, *names).filter(F.col(V.MONTH).isNotNull()).select("doc_number", "vendor_code", V.MONTH)
        rows.hint("rebalance", V.MONTH).write.mode("append").partitionBy(V.MONTH).parquet(path)
        table = C.register_location(spark, name, path, [V.MONTH], rows.schema)
    return table.filter(F.col(V.MONTH) >= "199501")


@query("reload_table")
def q_reload_table(spark, d):
    """A master table reloaded from itself."""
    path = scratch(spark, "master")
    TB.reload_table(TD.vendor_master(spark, d), path)
    old = TB.read_table(spark, path)
    TB.reload_table(old.select(F.lower("vendor_id").alias("vendor_id"), "company_code"), path)
    return TB.read_table(spark, path).join(old.select(F.lower("vendor_id").alias("vendor_id"), F.col("vendor_id").alias("was")),
                                           "vendor_id")


# Zones with and without clock changes.
ZONES = {"sao_paulo": H.HISTORY_ZONE, "new_york": "America/New_York", "kolkata": "Asia/Kolkata"}


@query("stamp_zone")
def q_stamp_zone(spark, d):
    """Instants as wall clocks, and back."""
    e = TD.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    walls = e.select("event_id", *[Z.wall_clock("ts", z).alias(n) for n, z in ZONES.items()])
    return walls.select("*", Z.is_repeated("new_york", ZONES["new_york"]).alias("twice"),
                        Z.instant_of("new_york", ZONES["new_york"], Z.EARLIER).alias("earlier"),
                        Z.instant_of("new_york", ZONES["new_york"], Z.LATER).alias("later"))


@query("align_schema")
def q_align_schema(spark, d):
    rows = TD.ledger(spark, d).withColumn("extra_note", F.lit("dropped")).drop("vendor_code")
    return S.align_to_schema(rows, S.get_schema("ledger-bronze"))


# ------------------------------------------------------------ run ledger ---

@query("process_lookup")
def q_process_lookup(spark, d):
    return K.process_lookup(TD.processes(spark, d), "finance 1", "raw to bronze", "sap1")


@query("process_lookup_ilike")
def q_process_lookup_ilike(spark, d):
    return K.process_lookup(TD.processes(spark, d), "FINANCE _", "raw%BRONZE", "sap1", use_ilike=True)


@query("run_start_ids")
def q_run_start_ids(spark, d):
    """A batch of starts, one of every active process."""
    starts = TD.processes(spark, d).filter("status = 'A'").select("process_id", "process_name", "step_name")
    return K.run_start_ids(TD.run_events(spark, d), starts, ["process_id"])


@query("active_rules")
def q_active_rules(spark, d):
    runs = K.run_starts(TD.run_events(spark, d))
    return R.active_rules_for_runs(runs, R.ledger_rules(spark), R.PHYSICAL)


@query("run_start")
def q_run_start(spark, d):
    return K.run_starts(TD.run_events(spark, d))


@query("run_last")
def q_run_last(spark, d):
    return K.run_last(TD.run_events(spark, d))


@query("run_last_flag")
def q_run_last_flag(spark, d):
    return K.run_last_flag(TD.run_events(spark, d))


@query("run_state")
def q_run_state(spark, d):
    return K.run_state(TD.run_events(spark, d))


@query("run_metrics")
def q_run_metrics(spark, d):
    counts = Q.route_counts(_evaluated(spark, d), ["file_name"]).select(
        F.array_position(F.array(*[F.lit(n) for n in TD.LEDGER_FILES]), F.col("file_name")).alias("run_id"),
        F.col("source_rows").alias("source_record_count"),
        F.col("accepted_rows").alias("target_record_count"))
    return K.metric_events(counts, "run_id", 2, 10, T3)


@query("process_parameters")
def q_process_parameters(spark, d):
    return K.process_parameters(TD.parameters(spark, d), "finance 2", "raw to bronze", "sap0")


# ------------------------------------------------------------ pipelines ---

from tollgate.plans import loads as L  # noqa: E402

LEDGER_TABLE = "ledger"
RAW_SPEC = DL.ReaderSpec(prefix="ledger", extension="txt", mask=EXTRACT_MASK)


def _bronze(spark, d, wh=None, source=None, run=None) -> L.Warehouse:
    wh = wh or L.Warehouse(scratch(spark, "warehouse"))
    landing = write_landing(spark, d, RAW_SPEC, source)
    L.bronze_load(spark, wh, LEDGER_TABLE, landing, EXTRACT_COLS, RAW_SPEC,
                  _physical_rules(), run or L.RunInfo(1, 2, T1), apply_mask=True)
    unstage(spark, landing)  # loaded
    return wh


def _layer_counts(df: DataFrame, target: str) -> DataFrame:
    reasons = F.col(Q.REASONS) if Q.REASONS in df.columns else F.lit("")
    return df.groupBy(F.lit(target).alias("target"), "file_name", reasons.alias(Q.REASONS)) \
             .agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


@query("bronze_load")
def q_bronze_load(spark, d):
    wh = _bronze(spark, d)
    return _layer_counts(wh.bronze(spark, LEDGER_TABLE).current(), "bronze").unionByName(
        _layer_counts(wh.bronze_rejected(spark, LEDGER_TABLE).current(), "bronze_rejected"))


SILVER_COLS = [c for c in TD.LEDGER_COLUMNS] + [V.MONTH]


@query("silver_load")
def q_silver_load(spark, d):
    wh = _bronze(spark, d)
    L.silver_load(spark, wh, LEDGER_TABLE, _business_rules(), _resolver(spark, d), L.RunInfo(2, 3, T2))
    return wh.silver(spark, LEDGER_TABLE).current().select(*SILVER_COLS)


def _silver_and_rejected(silver: DataFrame, rejected: DataFrame, more: list[str]) -> DataFrame:
    ok = silver.select(F.lit("silver").alias("target"), *SILVER_COLS, *more,
                       F.lit("").alias(X.REASONS), F.lit("").alias(X.ERROR_VALUE))
    return ok.unionByName(rejected.select(F.lit("silver_rejected").alias("target"), *SILVER_COLS, *more,
                                          X.REASONS, X.ERROR_VALUE))


@query("silver_load_with_rejects")
def q_silver_load_with_rejects(spark, d):
    wh = _bronze(spark, d)
    L.silver_load_with_rejects(spark, wh, LEDGER_TABLE, _business_rules(), _resolver(spark, d),
                               L.RunInfo(2, 3, T2))
    return _silver_and_rejected(wh.silver(spark, LEDGER_TABLE).current(),
                                wh.silver_rejected(spark, LEDGER_TABLE).current(), [])


@query("rejected_history")
def q_rejected_history(spark, d):
    def rejected_of(names):
        return Q.rejected(Q.evaluate(file_rows(spark, d, *names), _physical_rules(), batch_key="file_name"))
    h = H.stamp_history(rejected_of(FIRST), T1)
    return H.append_merge_schema(H.expire_all(h, T2), H.stamp_history(rejected_of(SECOND), T2))


@query("history_first_load")
def q_history_first_load(spark, d):
    store = HistoryStore(spark, scratch(spark, "history"), [V.MONTH])
    for run, (name, stamp) in enumerate(zip(TD.LEDGER_FILES, STAMPS), 1):
        store.append(file_rows(spark, d, name), run, stamp)
    return store.read()


# ------------------------------------------------------------ second runs ---

HISTORY_COLS = [H.VALID_FROM, H.VALID_TO, H.CURRENT, H.RUN]


def _two_deliveries(spark, d, silver=None) -> L.Warehouse:
    """The first two extracts, then the other two: bronze runs 1 and 3, each
    followed by a silver run (2 and 4) where ``silver`` is given."""
    wh = L.Warehouse(scratch(spark, "warehouse"))
    for first, names in ((1, FIRST), (3, SECOND)):
        source = TD.ledger(spark, d).filter(F.col("file_name").isin(*names))
        _bronze(spark, d, wh, source, L.RunInfo(first, 2, STAMPS[first - 1]))
        if silver is not None:
            silver(spark, wh, LEDGER_TABLE, _business_rules(), _resolver(spark, d),
                   L.RunInfo(first + 1, 3, STAMPS[first]))
    return wh


@query("bronze_reload")
def q_bronze_reload(spark, d):
    wh = _two_deliveries(spark, d)
    kept = ["row_id", *TD.LEDGER_COLUMNS, *HISTORY_COLS]
    ok = wh.bronze(spark, LEDGER_TABLE).read().select(F.lit("bronze").alias("target"), *kept, F.lit("").alias(Q.REASONS))
    return ok.unionByName(wh.bronze_rejected(spark, LEDGER_TABLE).read().select(
        F.lit("bronze_rejected").alias("target"), *kept, Q.REASONS))


@query("silver_reload")
def q_silver_reload(spark, d):
    wh = _two_deliveries(spark, d, L.silver_load)
    return wh.silver(spark, LEDGER_TABLE).read().select("row_id", *SILVER_COLS, *HISTORY_COLS)


@query("silver_rejects_reload")
def q_silver_rejects_reload(spark, d):
    wh = _two_deliveries(spark, d, L.silver_load_with_rejects)
    return _silver_and_rejected(wh.silver(spark, LEDGER_TABLE).read(),
                                wh.silver_rejected(spark, LEDGER_TABLE).read(), HISTORY_COLS)


@query("load_error_log")
def q_load_error_log(spark, d):
    wh = _two_deliveries(spark, d, L.silver_load_with_rejects)
    return L.read_error_log(spark, wh)


@query("load_run_state")
def q_load_run_state(spark, d):
    wh = _two_deliveries(spark, d, L.silver_load_with_rejects)
    return K.run_state(L.read_run_events(spark, wh), ["source_record_count", "target_record_count", "null_month_rows"])


@query("load_by_process")
def q_load_by_process(spark, d):
    """Both loads from names: process, parameters, rules and masters by table."""
    for name, frame in TD.masters(spark, d).items():
        frame.createOrReplaceTempView(name)
    control = L.ControlTables(TD.parameters(spark, d), R.ledger_rules(spark), X.catalog_resolver(spark))
    wh = L.Warehouse(scratch(spark, "warehouse"))
    landing = write_landing(spark, d, DL.ReaderSpec(delimiter="\t"))
    L.load_by_process(spark, wh, control, "Finance 2", "raw to bronze", "SAP0", 1, T1, LEDGER_TABLE, landing, EXTRACT_COLS)
    unstage(spark, landing)  # loaded
    L.load_by_process(spark, wh, control, "Finance 3", "bronze to silver", "SAP1", 2, T2, LEDGER_TABLE)
    return wh.silver(spark, LEDGER_TABLE).current().select(*SILVER_COLS)
