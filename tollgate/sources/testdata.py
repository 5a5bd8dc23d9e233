"""Inputs derived from the TPC-H-style test tables.

The ledger projection turns ``lineitem JOIN orders`` into a string-typed
finance extract with injected faults, so every rule, reference check and
history step has something to find.  The projections are plain DataFrame
expressions: they scale with the tables and keep column pruning and filter
pushdown intact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_COLUMNS = [
    "source_system", "company_code", "posting_date", "doc_type", "doc_number",
    "doc_line", "entry_date", "amount_lc", "vendor_code", "file_name",
]

# The extract file names of the ledger fixture, oldest first.
# The last one holds every order with a fault that rejects its whole extract.
FILE_1 = "ledger_20240101_120000.txt"
FILE_2 = "ledger_20240102_120000.txt"
FILE_3 = "ledger_20240103_120000.txt"
FILE_4 = "ledger_20240104_120000.txt"
LEDGER_FILES = [FILE_1, FILE_2, FILE_3, FILE_4]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ymd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def _s(c: Column) -> Column:
    return c.cast("string")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger fixture: every line of every order, in four extracts.

    Both tables grow with the input, so the join has one plan at all sizes."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").hint("merge")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    month = F.month("l_shipdate")
    return j.select(
        F.when(ok % 97 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("SYS"), _s(ok % 2))).alias("source_system"),
        F.concat(F.lit("C"), _s(F.col("l_suppkey") % 25)).alias("company_code"),
        F.concat(F.when(ok % 89 == 0, F.lit("x")).otherwise(F.lit("")),
                 _ymd(F.col("l_shipdate"))).alias("posting_date"),
        F.concat("l_returnflag", "l_linestatus").alias("doc_type"),
        _s(ok).alias("doc_number"),
        F.when(pk % 53 == 0, F.lit(None).cast("string"))
         .when(pk % 47 == 0, F.concat(_s(F.col("l_linenumber")), F.lit(".5")))
         .otherwise(_s(F.col("l_linenumber"))).alias("doc_line"),
        _ymd(F.col("o_orderdate")).alias("entry_date"),
        F.concat(_s(F.col("l_extendedprice").cast("decimal(15,2)")),
                 F.when(pk % 41 == 0, F.lit("-")).otherwise(F.lit(""))).alias("amount_lc"),
        F.when(pk % 37 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("V"), _s(F.col("l_suppkey")))).alias("vendor_code"),
        F.when((ok % 97 == 0) | (ok % 89 == 0), F.lit(FILE_4))
         .when((month % 3 == 0) & (ok % 3 == 2), F.lit(FILE_3))
         .when((month % 2 == 0) & (ok % 3 == 1), F.lit(FILE_2))
         .otherwise(F.lit(FILE_1)).alias("file_name"),
    )


def vendor_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return (s.filter(F.col("s_suppkey") % 7 != 0)
             .select(F.concat(F.lit("C"), _s(F.col("s_suppkey") % 25)).alias("company_code"),
                     F.concat(F.lit("V"), _s(F.col("s_suppkey"))).alias("vendor_id"))
             .distinct())


def company_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return (n.filter(F.col("n_nationkey") % 11 != 0)
             .select(F.concat(F.lit("C"), _s(F.col("n_nationkey"))).alias("company_code")))


def masters(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"master_vendor": vendor_master(spark, sf_dir),
            "master_company": company_master(spark, sf_dir)}


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-derived extract names for the file-name mask operator."""
    o = table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    name = F.concat(
        F.when(ok % 13 == 0, F.lit("other_")).otherwise(F.lit("ledger_")),
        F.when(ok % 11 == 0, F.lit("20241301")).otherwise(_ymd(F.col("o_orderdate"))),
        F.lit("_"),
        F.lpad(_s((F.col("o_custkey") * 167) % 300000), 6, "0"),
        F.when(ok % 17 == 0, F.lit("_x")).otherwise(F.lit("")),
        F.when(ok % 7 == 0, F.lit(".csv")).otherwise(F.lit(".txt")),
    )
    return o.select(ok.alias("file_id"), name.alias("file_name"))


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-ledger events derived from ``events``: every event starts a run of
    process ``user_id``; runs end (status C) unless the event is an error;
    each run records its source count.

    Columns: run_id, process_id, seq, event, attr, value, event_ts."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    start = e.select(F.col("event_id").alias("run_id"), F.col("user_id").alias("process_id"),
                     F.lit(1).alias("seq"), F.lit("START").alias("event"),
                     F.lit(None).cast("string").alias("attr"),
                     F.lit(None).cast("string").alias("value"), F.col("ts").alias("event_ts"))
    count = e.select(F.col("event_id").alias("run_id"), F.col("user_id").alias("process_id"),
                     F.lit(2).alias("seq"), F.lit("SET").alias("event"),
                     F.lit("source_count").alias("attr"),
                     _s(F.floor("value")).alias("value"), F.col("ts").alias("event_ts"))
    end = (e.filter(F.col("event_type") != "error")
            .select(F.col("event_id").alias("run_id"), F.col("user_id").alias("process_id"),
                    F.lit(3).alias("seq"), F.lit("END").alias("event"),
                    F.lit(None).cast("string").alias("attr"),
                    F.lit(None).cast("string").alias("value"),
                    (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("event_ts")))
    return start.unionByName(count).unionByName(end)


def processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Process table derived from the users of ``events``."""
    u = table(spark, sf_dir, "events").select("user_id").distinct()
    uid = F.col("user_id")
    return u.select(
        uid.alias("process_id"),
        F.concat(F.lit("Finance "), _s(uid % 5)).alias("process_name"),
        F.when(uid % 3 == 0, F.lit("RAW TO BRONZE")).when(uid % 3 == 1, F.lit("BRONZE TO SILVER"))
         .otherwise(F.lit("SP TO S3")).alias("step_name"),
        F.concat(F.lit("SAP"), _s(uid % 2)).alias("source_system"),
        F.when(uid % 7 == 0, F.lit("I")).otherwise(F.lit("A")).alias("status"))


def parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameter table: one active row per process of ``processes``, with the
    reader settings of its extracts; inactive processes keep an old row."""
    p = processes(spark, sf_dir)
    step = F.col("process_id") % 3
    return p.withColumn("process_name", F.concat(F.lit("Finance "), _s(F.col("process_id")))).withColumn(
        "step_name", F.when(step == 2, F.lit("RAW TO BRONZE")).when(step == 0, F.lit("BRONZE TO SILVER"))
        .otherwise(F.lit("SP TO S3"))).select(
        "*", F.lit("ledger").alias("file_prefix"), F.lit("txt").alias("file_extension"),
        F.lit("{fileName}_{yyyymmdd}_{hhmmss}.{fileExtension}").alias("file_mask"),
        F.when(F.col("process_id") % 2 == 0, F.lit("\t")).otherwise(F.lit("|")).alias("file_delimiter"),
        F.lit("ledger-raw").alias("schema_name"))
