import pytest

from tollgate.functions.rules import CROSS_REFERENCE, Rule
from tollgate.operators import references as X

VENDOR = Rule(9, "v", CROSS_REFERENCE, master_table="mv", keys=(("c", "mc"), ("v", "mv")))
COMPANY = Rule(10, "c", CROSS_REFERENCE, master_table="mc", keys=(("c", "mc"),))


@pytest.fixture()
def masters(spark):
    return {"mv": spark.createDataFrame([("C1", "V1"), ("C1", "V1")], "mc string, mv string"),
            "mc": spark.createDataFrame([("C1",)], "mc string")}


def data(spark):
    return spark.createDataFrame([("C1", "V1", 1), ("C1", "V2", 2), ("C2", "V1", 3), (None, "V1", 4)],
                                 "c string, v string, n int")


def test_annotate_preserves_rows_and_marks(spark, masters):
    out = {r.n: (r.c, r.v) for r in X.annotate(data(spark), [VENDOR, COMPANY],
                                               X.mapping_resolver(masters)).collect()}
    assert out == {1: ("C1", "V1"),
                   2: ("TBD", "TBD"),      # vendor rule marks both of its keys (kept behaviour)
                   3: ("TBD", "TBD"),      # both rules miss: both apply
                   4: ("UNSP", "TBD")}     # sentinel stays


def test_reject_reasons_and_markers(spark, masters):
    rej = {r.n: (r.reject_reasons, r.error_value)
           for r in X.reject(data(spark), [VENDOR, COMPANY], X.mapping_resolver(masters)).collect()}
    assert rej == {2: ("9", "TBD||TBD"), 3: ("9,10", "TBD||TBD||TBD"), 4: ("9,10", "UNSP||TBD||UNSP")}


def test_missing_master_policies(spark, masters):
    absent = Rule(11, "v", CROSS_REFERENCE, master_table="nope", keys=(("v", "mv"),))
    res = X.mapping_resolver(masters)
    skip = X.annotate(data(spark), [absent], res).collect()
    assert [r.v for r in skip] == ["V1", "V2", "V1", "V1"]
    with pytest.raises(LookupError):
        X.annotate(data(spark), [absent], res, missing_master=X.FAIL)
    allrej = X.reject(data(spark), [absent], res, missing_master=X.REJECT_ALL)
    assert allrej.count() == 4


def test_error_log_values(spark, masters):
    df = data(spark).selectExpr("*", "cast(n as string) as row_id")
    log = sorted(tuple(r) for r in X.error_log(df, [COMPANY], X.mapping_resolver(masters), 5).collect())
    assert log == [(5, 10, "3", "C2"), (5, 10, "4", "UNSP")]
