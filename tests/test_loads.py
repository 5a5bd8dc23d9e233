import uuid

import pytest
from pyspark.sql import functions as F

from tollgate.functions.rules import CROSS_REFERENCE, NOT_NULL, Rule
from tollgate.operators import runs as K
from tollgate.plans import loads as L
from tollgate.session import checkpoint_dir
from tollgate.sources import delimited as DL
from tollgate.sources.history_store import RunInUse

SPEC = DL.ReaderSpec(prefix="led", extension="txt")
NAMES = ["k", "posting_date"]
FILE = "led_20240101_120000.txt"


@pytest.fixture()
def base(spark):
    return f"{checkpoint_dir(spark)}/batch-{uuid.uuid4().hex}"


def land(spark, folder, rows, name=FILE):
    DL.write_delimited(spark.createDataFrame(rows, "k string, posting_date string"), f"{folder}/{name}")


def bronze(spark, wh, landing, run, rules, table="t", **more):
    return L.bronze_load(spark, wh, table, landing, NAMES, SPEC, rules, L.RunInfo(run, 2, f"2024-01-0{run} 00:00:00"), **more)


def test_reload_skips_loaded_files_and_reports_null_months(spark, base):
    land(spark, f"{base}/landing", [("a", "20240105"), ("b", "bad")])
    wh = L.Warehouse(f"{base}/wh")
    bronze(spark, wh, f"{base}/landing", 1, [Rule(1, "k", NOT_NULL)])
    again = bronze(spark, wh, f"{base}/landing", 2, [Rule(1, "k", NOT_NULL)], skip_loaded=True)
    assert again["source"] == 0
    assert wh.bronze(spark, "t").current().count() == 2      # the empty run superseded nothing
    assert wh.bronze(spark, "t").current().first().sys_status_code == "A"
    L.silver_load(spark, wh, "t", [], lambda name: None, L.RunInfo(3, 3, "2024-01-03 00:00:00"))
    state = K.run_state(L.read_run_events(spark, wh), ["null_month_rows", "source_record_count"])
    row = state.filter(F.col("run_id") == 3).first()
    assert (row.status, row.null_month_rows, row.source_record_count) == ("C", "1", "1")


def test_retry_with_the_other_verdict(spark, base):
    land(spark, f"{base}/landing", [("a", None)])
    wh = L.Warehouse(f"{base}/wh")
    bronze(spark, wh, f"{base}/landing", 1, [Rule(1, "posting_date", NOT_NULL)])
    assert wh.bronze(spark, "t").current().count() == 0      # a table without rows can be read
    bronze(spark, wh, f"{base}/landing", 1, [])
    assert wh.bronze(spark, "t").current().count() == 1
    assert wh.bronze_rejected(spark, "t").read().count() == 0
    assert L.read_error_log(spark, wh).count() == 0
    assert L.read_run_events(spark, wh).filter("event = 'START'").count() == 1


def test_two_tables_in_one_run_keep_their_logs_and_foreign_runs_are_refused(spark, base):
    wh, rules = L.Warehouse(f"{base}/wh"), [Rule(1, "k", NOT_NULL)]
    land(spark, f"{base}/one", [(None, "20240101")])
    land(spark, f"{base}/two", [(None, "20240101")])
    bronze(spark, wh, f"{base}/one", 1, rules, "t1")
    bronze(spark, wh, f"{base}/two", 1, rules, "t2")
    assert sorted(r.object_name for r in L.read_error_log(spark, wh).collect()) == ["t1", "t2"]
    with pytest.raises(RunInUse):
        bronze(spark, wh, f"{base}/two", 1, rules, "t1")


def test_malformed_lines_go_to_bronze_rejected(spark, base):
    spark.createDataFrame([("a\t20240101",), ("b\t20240101\tmore",), ("c",)], "v string").write.text(f"{base}/landing/{FILE}")
    wh = L.Warehouse(f"{base}/wh")
    got = bronze(spark, wh, f"{base}/landing", 1, [Rule(1, "posting_date", NOT_NULL, reject_all=True)])
    assert got == {"source": 3, "accepted": 1}
    bad = {r[DL.CORRUPT]: r.reject_reasons for r in wh.bronze_rejected(spark, "t").current().collect()}
    assert bad == {"b\t20240101\tmore": "malformed", "c": "malformed"}


@pytest.mark.parametrize("folder", ["land ing", "land%20ing", "land+ing", "öd é"])
def test_file_lineage_with_odd_names(spark, base, folder):
    name = "led 1_é+%41.txt"
    land(spark, f"{base}/{folder}", [("a", "20240101")], name)
    wh = L.Warehouse(f"{base}/wh")
    bronze(spark, wh, f"{base}/{folder}", 1, [])
    assert [r.file_name for r in wh.bronze(spark, "t").current().collect()] == [name]
    assert bronze(spark, wh, f"{base}/{folder}", 2, [], skip_loaded=True)["source"] == 0


def test_reject_mode_writes_the_log_of_the_same_misses(spark, base):
    land(spark, f"{base}/landing", [("a", "20240101"), ("b", "20240101"), (None, "bad")])
    wh = L.Warehouse(f"{base}/wh")
    bronze(spark, wh, f"{base}/landing", 1, [])
    rule = Rule(9, "k", CROSS_REFERENCE, master_table="m", keys=(("k", "id"),))
    masters = {"m": spark.createDataFrame([("a",)], "id string")}.get
    got = L.silver_load_with_rejects(spark, wh, "t", [rule], masters, L.RunInfo(2, 3, "2024-01-02 00:00:00"))
    assert got == {"source": 2, "accepted": 1}
    assert [(r.run_id, r.rule_id, r.error_value) for r in L.read_error_log(spark, wh).collect()] == [(2, 9, "b")]
    row = K.run_state(L.read_run_events(spark, wh), ["null_month_rows"]).filter("run_id = 2").first()
    assert row.null_month_rows == "1"


def test_load_leaves_nothing_in_the_shared_folder(spark, base):
    land(spark, f"{base}/landing", [("a", "20240101")])
    before = set(DL.list_entries(spark, checkpoint_dir(spark)))
    wh = L.Warehouse(f"{base}-wh")
    bronze(spark, wh, f"{base}/landing", 1, [])
    L.silver_load(spark, wh, "t", [], lambda name: None, L.RunInfo(2, 3, "2024-01-02 00:00:00"))
    left = set(DL.list_entries(spark, checkpoint_dir(spark))) - before
    assert {n for n in left if not n.startswith("batch-")} == set()
    assert not DL.list_entries(spark, checkpoint_dir(spark).rstrip("/") + "/rdd-0")


def test_a_load_that_breaks_off_is_not_seen(spark, base, monkeypatch):
    """Bronze, rejected rows and the loaded files of a run are seen together, when it has ended."""
    land(spark, f"{base}/landing", [("a", "20240101"), (None, "20240101")])
    wh, rules = L.Warehouse(f"{base}/wh"), [Rule(1, "k", NOT_NULL)]
    bronze(spark, wh, f"{base}/landing", 1, rules)
    land(spark, f"{base}/landing", [("b", "20240102"), ("c", "20240102"), (None, "20240102"), (None, "bad")], "led_20240102_120000.txt")

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(L, "_write_error_log", lost)
    with pytest.raises(RuntimeError):
        bronze(spark, wh, f"{base}/landing", 2, rules, skip_loaded=True)
    monkeypatch.undo()
    assert [r.k for r in wh.bronze(spark, "t").current().collect()] == ["a"]
    assert wh.bronze_rejected(spark, "t").current().count() == 1
    state = K.run_state(L.read_run_events(spark, wh)).filter("run_id = 2").first()
    assert state.status == "E"
    got = bronze(spark, wh, f"{base}/landing", 3, rules, skip_loaded=True)      # under a new id, as nothing was loaded
    assert got == {"source": 4, "accepted": 2}
    assert sorted(r.k for r in wh.bronze(spark, "t").current().collect()) == ["b", "c"]


def test_gate_of_one_extract_does_not_reach_the_others(spark, base):
    land(spark, f"{base}/landing", [("a", "20240101"), ("b", None)])
    land(spark, f"{base}/landing", [("c", "20240102"), (None, "20240102")], "led_20240102_120000.txt")
    wh = L.Warehouse(f"{base}/wh")
    rules = [Rule(7, "posting_date", NOT_NULL, reject_all=True), Rule(1, "k", NOT_NULL)]
    assert bronze(spark, wh, f"{base}/landing", 1, rules) == {"source": 4, "accepted": 1}
    assert sorted((r.k or "", r.reject_reasons) for r in wh.bronze_rejected(spark, "t").current().collect()) == [
        ("", "1"), ("a", "7"), ("b", "7")]
    assert sorted((r.rule_id, r.error_value) for r in L.read_error_log(spark, wh).collect()) == [(1, "None"), (7, "None")]
