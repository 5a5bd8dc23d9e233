"""Reference quirks: kept (D4, D7, D8, D15, D16) or fixed (D1, D2, D3, D9)."""

from pyspark.sql import functions as F

from tollgate.functions.rules import NOT_NULL, Rule
from tollgate.operators import quality as Q
from tollgate.operators import versions as V
from tollgate.operators.rowids import row_ids


def test_d2_row_ids_repeatable(spark):
    df = spark.range(0, 2000).select((F.col("id") % 17).cast("string").alias("k"),
                                     (F.col("id") % 5).alias("v"))
    a = sorted(map(tuple, row_ids(df, 1).collect()))
    b = sorted(map(tuple, row_ids(df, 1).collect()))
    assert a == b


def test_d9_quotes_in_logged_values(spark):
    df = spark.createDataFrame([("it's", None, "r1")], "a string, b string, rid string")
    log = Q.error_log(df, [Rule(5, "b", NOT_NULL), Rule(6, "a", "no_such")], 3, "rid").collect()
    assert [(r.rule_id, r.error_value) for r in log] == [(5, "None")]
    df2 = spark.createDataFrame([(None, "it's", "r1")], "a string, b string, rid string")
    log2 = Q.error_log(df2, [Rule(5, "a", "not_null")], 3, "rid").collect()
    assert log2[0].error_value == "None"


def test_d15_newest_file_per_whole_month(spark):
    df = spark.createDataFrame(
        [("202401", "f_20240101.txt", 1), ("202401", "f_20240102.txt", 2), ("202402", "f_20240101.txt", 3),
         (None, "f_20240102.txt", 4)], "posting_month string, file_name string, n int")
    kept = sorted(r.n for r in V.latest_version(df).collect())
    # month 202402 still comes from the older file; the NULL-month row drops out (D16)
    assert kept == [2, 3]
    assert V.null_month_rows(df).count() == 1
