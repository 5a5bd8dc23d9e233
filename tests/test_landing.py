import pytest

from tollgate.plans import registry as G
from tollgate.sources import delimited as DL
from tollgate.sources import files
from tollgate.sources import testdata as TD

SF = "/root/testdata/sf0.001"
COLS = G.EXTRACT_COLS


def rows(df):
    return sorted(map(tuple, df.select(*COLS).collect()), key=repr)


@pytest.mark.parametrize("spec", [DL.ReaderSpec(), DL.ReaderSpec(delimiter="|", encoding="UTF-8")])
def test_extracts_and_decoy_hold_the_ledger(spark, spec, monkeypatch):
    monkeypatch.setattr(G, "PART_ROWS", 500)
    root = G.write_landing(spark, SF, spec)
    decoy = "other_20240101_120000.csv"
    assert files.entries(spark, root) == [*TD.LEDGER_FILES, decoy]
    led = TD.ledger(spark, SF).withColumn("city", G.F.lit(G.CITY))
    for name in TD.LEDGER_FILES:
        found = DL.scan_delimited(spark, f"{root}/{name}", COLS, spec)
        assert rows(found) == rows(led.filter(G.F.col("file_name") == name))
    assert rows(DL.scan_delimited(spark, f"{root}/{decoy}", COLS, spec)) == rows(led)
    assert len([n for n in files.entries(spark, f"{root}/{TD.FILE_1}") if n.startswith("part-")]) > 1


def test_every_call_writes_its_own_landing_without_a_copy(spark):
    kept = files.entries(spark, G.checkpoint_dir(spark))
    first, second = G.write_landing(spark, SF), G.write_landing(spark, SF)
    assert first != second
    new = set(files.entries(spark, G.checkpoint_dir(spark))) - set(kept)
    assert new == {first.rsplit("/", 1)[1], second.rsplit("/", 1)[1]}      # no checkpoint of the rows beside them


def test_a_landing_without_rows(spark):
    root = G.write_landing(spark, SF, source=TD.ledger(spark, SF).filter("false"))
    assert DL.scan_delimited(spark, f"{root}/other_20240101_120000.csv", COLS).count() == 0


def test_the_ledger_has_one_plan_at_all_sizes(spark):
    plan = TD.ledger(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
