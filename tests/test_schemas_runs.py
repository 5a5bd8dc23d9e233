import datetime as dt

import pytest
from pyspark.sql import types as T

from tollgate.operators import runs as K
from tollgate.sources import schemas as S


def test_registry():
    assert S.get_schema("ledger-silver")["amount_lc"].dataType == T.DecimalType(25, 5)
    with pytest.raises(ValueError):
        S.get_schema("nope")


def test_process_parameters_needs_exactly_one_row(spark):
    table = spark.createDataFrame(
        [("Fin", "Raw to Bronze", "S1", "A", 1), ("Fin", "Raw to Bronze", "S2", "A", 2), ("Fin", "Raw to Bronze", "S2", "I", 3)],
        "process_name string, step_name string, source_system string, status string, process_id int")
    assert K.process_parameters(table, "fin", "RAW TO BRONZE", "s2").first().process_id == 2
    with pytest.raises(K.ParameterError, match="2 active"):
        K.process_parameters(table, "fin", "raw to bronze")
    with pytest.raises(K.ParameterError, match="0 active"):
        K.process_parameters(table, "fin", "raw to bronze", "s9")


def test_conform_reports_failures(spark):
    schema = T.StructType([S.field("d", T.DateType(), False, fmt="yyyyMMdd"),
                           S.field("n", T.DecimalType(15, 5))])
    df = spark.createDataFrame([("20240101", "1.5"), ("2024x", "x"), (None, None)], "d string, n string")
    got = [r.conform_errors for r in S.conform_typed(df, schema).collect()]
    assert got == ["", "d,n", "d"]


def test_apply_defaults_and_not_null(spark):
    spec = T.StructType([S.field("a", T.StringType(), False),
                         S.field("s", T.StringType(), False, default="'A'")])
    out = S.apply_defaults(spark.createDataFrame([("x",)], "a string"), spec).first()
    assert (out.a, out.s) == ("x", "A")
    bad = S.apply_defaults(spark.createDataFrame([(None,)], "a string"), spec)
    with pytest.raises(Exception):
        bad.collect()


def test_align(spark):
    spec = T.StructType([S.field("b", T.IntegerType()), S.field("a", T.StringType())])
    out = S.align_to_schema(spark.createDataFrame([("x", 9)], "a string, z int"), spec)
    assert out.columns == ["b", "a"] and out.first().b is None


def test_run_state_pessimistic(spark):
    t = dt.datetime(2024, 1, 1)
    ev = (K.event(spark, 1, 7, 1, K.START, ts=t)
          .unionByName(K.event(spark, 1, 7, 2, K.SET, "source_count", 10, t))
          .unionByName(K.event(spark, 1, 7, 3, K.SET, "source_count", 12, t))
          .unionByName(K.event(spark, 1, 7, 4, K.END, ts=t))
          .unionByName(K.event(spark, 2, 7, 1, K.START, ts=t)))
    st = {r.run_id: (r.status, r.source_count) for r in K.run_state(ev).collect()}
    assert st == {1: ("C", "12"), 2: ("E", None)}
    flags = {r.run_id: r.last_flag for r in K.run_last_flag(ev).collect()}
    assert flags == {1: 0, 2: 1}
