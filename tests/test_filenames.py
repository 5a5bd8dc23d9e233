import pytest

from tollgate.functions.filenames import mask_predicate

MASK = "{fileName}_{yyyymmdd}_{hhmmss}.{fileExtension}"


@pytest.mark.parametrize("name,ok", [
    ("ledger_20240101_120000.txt", True),
    ("LEDGER_20240101_120000.TXT", True),
    ("ledger_20240101_120000_x.txt", True),     # trailing tokens accepted
    ("ledger_20241301_120000.txt", False),      # month 13
    ("ledger_20240101_250000.txt", False),      # hour 25
    ("ledger_2024011_120000.txt", False),       # 7-char date
    ("ledger_20240101_1200000.txt", False),     # 7-char time
    ("ledger_20240101_120000.csv", False),
    ("other_20240101_120000.txt", False),
    ("ledger_20240101.txt", False),
    ("ledger_20240101_120000.txt.gz", False),   # extension is everything after the first dot
])
def test_mask(spark, name, ok):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(mask_predicate("n", MASK, "ledger", "txt")).first()[0] is ok


def test_source_system_token(spark):
    df = spark.createDataFrame([("fin_sap_20240101_120000.txt",), ("fin_20240101_120000.txt",)], "n string")
    got = [r[0] for r in df.select(mask_predicate(
        "n", "{fileName}_{sourceSystem}_{yyyymmdd}_{hhmmss}.{fileExtension}", "fin", "txt")).collect()]
    assert got == [True, False]
