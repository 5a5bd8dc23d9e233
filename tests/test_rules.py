import pytest
from pyspark.sql import functions as F

from tollgate.functions import rules as R


def outcome(spark, values, rule, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(R.failure(rule).alias("f")).collect()]


@pytest.mark.parametrize("value,fails", [
    ("12.5", False), (" 12 ", False), ("1e3", False), ("1.123456789", False),
    ("100.00-", True), ("1,234.50", True), ("12345678901.5", True), (None, False), ("abc", True),
])
def test_numeric_decimal_edges(spark, value, fails):
    rule = R.Rule(1, "x", R.NUMERIC_FORMAT, "decimal(15,5)")
    assert outcome(spark, [value], rule) == [fails]


@pytest.mark.parametrize("value,fails", [("7", False), ("1.5", True), ("1e3", True), (None, False)])
def test_numeric_integer_edges(spark, value, fails):
    assert outcome(spark, [value], R.Rule(1, "x", R.NUMERIC_FORMAT, "integer")) == [fails]


def test_date_format(spark):
    rule = R.Rule(1, "x", R.DATE_FORMAT, "yyyyMMdd")
    assert outcome(spark, ["20240229", "20230229", "x20240101", None], rule) == [False, True, True, False]


def test_not_null(spark):
    assert outcome(spark, ["a", None], R.Rule(1, "x", R.NOT_NULL)) == [False, True]


def test_null_predicate_passes(spark):
    df = spark.createDataFrame([("a", None), ("b", "a")], "x string, y string")
    oor = R.Rule(1, "x", R.OUT_OF_RANGE, "< y")
    cf = R.Rule(2, "y", R.CONDITIONAL_FAIL, "y > 'Z'")
    got = df.select(R.failure(oor).alias("a"), R.failure(cf).alias("b")).collect()
    assert [tuple(r) for r in got] == [(False, False), (True, True)]


def test_unknown_code_passes(spark):
    assert outcome(spark, ["anything", None], R.Rule(1, "x", "no_such")) == [False, False]


def test_key_pairs_parse():
    assert R.parse_key_pairs('[("a", "b"), ("c","d")]') == (("a", "b"), ("c", "d"))


def test_rule_table_roundtrip(spark):
    rules = R.collect_rules(R.ledger_rules(spark).filter(F.col("status") == "A"))
    assert [r.rule_id for r in rules] == [11, 12, 13, 14, 15, 21, 22, 23, 24, 31, 32]
    assert rules[-1].keys == (("vendor_code", "vendor_id"), ("company_code", "company_code"))


def test_check_columns(spark):
    df = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(ValueError):
        R.check_columns(df, [R.Rule(1, "missing", R.NOT_NULL)])
