import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from oracle import ORACLES
    from tollgate.plans.registry import QUERIES
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
