from tollgate.functions.rules import Rule, NOT_NULL, NUMERIC_FORMAT
from tollgate.operators import quality as Q

RULES = [Rule(1, "a", NOT_NULL, reject_all=True), Rule(2, "b", NOT_NULL, reject_all=True),
         Rule(4, "c", NUMERIC_FORMAT, "integer"), Rule(5, "b", NOT_NULL)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "f string, a string, b string, c string, rid string")


def test_gate_rejects_whole_batch_only(spark):
    df = frame(spark, [("f1", None, "x", "1", "r1"), ("f1", "a", "x", "1", "r2"),
                       ("f2", "a", "x", "x", "r3"), ("f2", "a", None, "2", "r4")])
    # f2 also fails batch rule 2 (b null) -> whole file rejected with "2"
    ev = {r.rid: r[Q.REASONS] for r in Q.evaluate(df, RULES, batch_key="f").collect()}
    assert ev == {"r1": "1", "r2": "1", "r3": "2", "r4": "2"}


def test_row_rules_in_rule_order(spark):
    df = frame(spark, [("f1", "a", "x", "x", "r1"), ("f1", "a", "x", "1", "r2")])
    ev = {r.rid: r[Q.REASONS] for r in Q.evaluate(df, RULES, batch_key="f").collect()}
    assert ev == {"r1": "4", "r2": ""}


def test_accepted_plus_rejected_is_source(spark):
    df = frame(spark, [("f1", "a", "x", str(i) if i % 3 else "z", f"r{i}") for i in range(50)])
    acc, rej = Q.split(df, RULES)
    assert acc.count() + rej.count() == 50
    assert Q.REASONS not in acc.columns


def test_error_log_own_column_and_none_text(spark):
    df = frame(spark, [("f1", None, None, "1", "r1")])
    log = sorted(tuple(r) for r in Q.error_log(df, RULES, 9, "rid").collect())
    # each batch rule logs its own column; NULL is logged as 'None'
    assert log == [(9, 1, "r1", "None"), (9, 2, "r1", "None")]


def test_rule_fail_counts(spark):
    df = frame(spark, [("f1", "a", "x", "x", "r1"), ("f1", "a", None, "1", "r2")])
    got = {r.rule_id: r.failed_rows for r in Q.rule_fail_counts(df, RULES).collect()}
    assert got == {1: 0, 2: 1, 4: 1, 5: 1}


def test_no_rules_accepts_everything(spark):
    df = frame(spark, [("f1", None, None, None, "r1")])
    assert Q.evaluate(df, []).first()[Q.REASONS] == ""
