import uuid

from tollgate.session import checkpoint_dir
from tollgate.sources import delimited as DL


def test_latin1_roundtrip_and_ingest(spark):
    root = f"{checkpoint_dir(spark)}/land-{uuid.uuid4().hex}"
    df = spark.createDataFrame([("São", None), ("b", "x")], "a string, b string")
    DL.write_delimited(df, f"{root}/Fin_20240101_120000.TXT")
    DL.write_delimited(df, f"{root}/fin_20240101_120000.csv")
    out = DL.ingest(spark, root, ["a", "b"], DL.ReaderSpec(prefix="fin", extension="txt"))
    got = sorted((r.a, r.b, r.file_name) for r in out.collect())
    assert got == [("São", None, "Fin_20240101_120000.TXT"), ("b", "x", "Fin_20240101_120000.TXT")]


def test_malformed_rows_flagged(spark):
    root = f"{checkpoint_dir(spark)}/land-{uuid.uuid4().hex}"
    spark.createDataFrame([("a\tb",), ("a\tb\tc",), ("a",)], "v string").write.text(f"{root}/x.txt")
    out = DL.scan_delimited(spark, f"{root}/x.txt", ["p", "q"], flag_malformed=True)
    bad = sorted(r[DL.CORRUPT] for r in out.collect() if r[DL.CORRUPT] is not None)
    assert bad == ["a", "a\tb\tc"]
