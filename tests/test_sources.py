import datetime as dt
import uuid
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions import zones as Z
from tollgate.operators import references as X
from tollgate.operators import runs as K
from tollgate.plans import loads as L
from tollgate.session import checkpoint_dir
from tollgate.sources import catalog as C
from tollgate.sources import delimited as DL
from tollgate.sources import files
from tollgate.sources import listing as LS
from tollgate.sources import mixed as MX
from tollgate.sources import schemas as S
from tollgate.sources import tables as TB


@pytest.fixture()
def base(spark):
    return f"{checkpoint_dir(spark)}/src-{uuid.uuid4().hex}"


def put(spark, path, data: bytes):
    p, fs = files.hadoop_path(spark, path)
    out = fs.create(p)
    out.write(bytearray(data))
    out.close()


# ---------------------------------------------------------------- mixed ---

TAB = MX.Source("tab", DL.ReaderSpec(prefix="led", extension="txt"), ("k", "v"))
PIPE = MX.Source("pipe", DL.ReaderSpec(delimiter="|", encoding="UTF-8", header=True, prefix="led", extension="psv"), ("v", "k", "w"))


def test_one_scan_over_two_formats(spark, base):
    put(spark, f"{base}/led_1.txt", "São\t1\n\n \t \nb\t\n\"q\tr\"\t3\n".encode("latin-1"))
    put(spark, f"{base}/led_2.psv/part-0", " V |k|W\r\né|2|x\r\n".encode())
    put(spark, f"{base}/led_2.psv/part-1", b"V|K|w\nlast|9|\nto|o|ma|ny\nfew\n")
    put(spark, f"{base}/other.csv", b"no,no\n")
    got = MX.scan_mixed(spark, base, [TAB, PIPE], flag_malformed=True)
    rows = sorted(((r.source, r.file_name, r.k, r.v, r.w, r[DL.CORRUPT]) for r in got.collect()), key=repr)
    good = [r for r in rows if r[5] is None]
    assert good == [("pipe", "led_2.psv", "2", "é", "x", None), ("pipe", "led_2.psv", "9", "last", None, None),
                    ("tab", "led_1.txt", "São", "1", None, None), ("tab", "led_1.txt", "b", None, None, None),
                    ("tab", "led_1.txt", "q\tr", "3", None, None)]
    assert sorted(r[5] for r in rows if r[5]) == ["few", "to|o|ma|ny"]
    fresh = MX.scan_mixed(spark, base, [TAB, PIPE])
    assert fresh._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1


def test_headers_that_are_missing_and_names_that_fit_twice(spark, base):
    put(spark, f"{base}/led_1.psv", b"a|b|c\n")
    put(spark, f"{base}/led_2.psv", b"v|k|w\na|b|c\n")
    assert [r.file_name for r in MX.header_missing(spark, base, [TAB, PIPE]).collect()] == ["led_1.psv"]
    twice = MX.Source("more", DL.ReaderSpec(prefix="l", extension="psv"), ("a",))
    with pytest.raises(MX.AmbiguousSource, match="led_1.psv, led_2.psv"):
        MX.scan_mixed(spark, base, [PIPE, twice])
    with pytest.raises(ValueError, match="UTF-16"):
        MX.scan_mixed(spark, base, [MX.Source("wide", DL.ReaderSpec(encoding="UTF-16", prefix="led", extension="psv"), ("a",))])
    assert MX.scan_mixed(spark, f"{base}/absent", [TAB]).count() == 0


# -------------------------------------------------------------- listing ---

def test_listing_with_nested_folders(spark, base):
    put(spark, f"{base}/led_20240101_120000.txt/part-0", b"abc")
    put(spark, f"{base}/led_20240101_120000.txt/deep er/part-1", b"de")
    put(spark, f"{base}/led_20240101_120000.txt/_SUCCESS", b"")
    put(spark, f"{base}/LED_20240102_120000.TXT", b"x")
    put(spark, f"{base}/led_20241301_120000.txt", b"no such day")
    spec = DL.ReaderSpec(prefix="led", extension="txt", mask="{fileName}_{yyyymmdd}_{hhmmss}.{fileExtension}")
    got = sorted((r.file_name, r.files, r.bytes) for r in LS.list_extracts(spark, base, spec).collect())
    assert got == [("LED_20240102_120000.TXT", 1, 1), ("led_20240101_120000.txt", 2, 5)]
    names = sorted(r.name for r in LS.list_files(spark, base).collect())
    assert names == ["LED_20240102_120000.TXT", "led_20241301_120000.txt", "part-0", "part-1"]
    plan = LS.list_files(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]               # no file is opened


# -------------------------------------------------------------- catalog ---

SPEC = T.StructType([S.field("a", T.StringType(), False, "the key's name"), S.field("b", T.StringType(), True, default="'A'"),
                     S.field("n", T.IntegerType(), False, default="7")])


def name():
    return f"tg_{uuid.uuid4().hex}"


def test_catalog_defaults_and_evolution(spark, base):
    t = name()
    C.create_table(spark, t, SPEC, base)
    C.create_table(spark, t, SPEC, base)                              # if it is not there
    C.insert_rows(spark.createDataFrame([("x",)], "a string"), t, SPEC)
    C.insert_rows(spark.createDataFrame([("5", "y")], "n string, a string"), t, SPEC)
    newer = T.StructType([SPEC["a"], S.field("b", T.StringType(), True, "letter", "'B'"), SPEC["n"],
                          S.field("c", T.DateType(), True, "day", "DATE '2024-02-29'")])
    C.evolve_table(spark, t, newer)
    C.evolve_table(spark, t, newer)
    C.insert_rows(spark.createDataFrame([("z",)], "a string"), t, newer)
    day = dt.date(2024, 2, 29)
    assert sorted(map(tuple, spark.table(t).select("a", "b", "n", "c").collect())) == [
        ("x", "A", 7, day), ("y", "A", 5, day), ("z", "B", 7, day)]
    comments = {f.name: f.metadata.get("comment") for f in spark.table(t).schema}
    assert comments["a"] == "the key's name" and comments["b"] == "letter" and comments["c"] == "day"
    assert C.table_defaults(spark, t) == {"b": "'B'", "n": "7", "c": "DATE '2024-02-29'"}
    same = S.apply_defaults(spark.createDataFrame([("z",)], "a string"), newer).collect()
    assert [tuple(r) for r in spark.table(t).filter("a = 'z'").select(*newer.names).collect()] == [tuple(r) for r in same]


def test_catalog_refuses(spark, base):
    t = name()
    C.create_table(spark, t, SPEC, base)
    with pytest.raises(ValueError, match="unknown columns"):
        C.insert_rows(spark.createDataFrame([("x", 1)], "a string, q int"), t, SPEC)
    with pytest.raises(ValueError, match="without a value"):
        C.insert_rows(spark.createDataFrame([("x",)], "b string"), t, SPEC)
    with pytest.raises(Exception, match="NOT NULL column a"):
        C.insert_rows(spark.createDataFrame([(None,)], "a string"), t, SPEC)
    with pytest.raises(ValueError, match="n: int to string"):
        C.evolve_table(spark, t, T.StructType([SPEC["a"], SPEC["b"], S.field("n", T.StringType())]))
    with pytest.raises(ValueError, match="no table name"):
        C.create_table(spark, "a; DROP TABLE b", SPEC, base)
    assert spark.table(t).count() == 0


def test_located_table_takes_up_partitions(spark, base):
    t, rows = name(), spark.createDataFrame([("v1", "202401"), ("v2", "202402")], "v string, m string")
    rows.write.partitionBy("m").parquet(base)
    C.register_location(spark, t, base, ["m"], rows.schema)
    rows.select("v", F.lit("202403").alias("m")).write.mode("append").partitionBy("m").parquet(base)
    found = C.register_location(spark, t, base, ["m"], rows.schema)
    assert found.count() == 4 and spark.read.parquet(base).count() == 4
    plan = found.filter("m = '202403'")._jdf.queryExecution().executedPlan().toString()
    assert "m=202403" in plan or "PartitionFilters: [isnotnull(m" in plan
    assert found.filter("m = '202403'").inputFiles() and all("m=202403" in f for f in found.filter("m = '202403'").inputFiles())
    with pytest.raises(ValueError, match="stands for"):
        C.register_location(spark, t, f"{base}-other", ["m"], rows.schema)
    rule = X.Rule(1, "k", "cross_reference", None, master_table=t, keys=(("k", "v"),))
    source = spark.createDataFrame([("v1",), ("v9",)], "k string")
    assert [r.k for r in X.anti(source, rule, X.catalog_resolver(spark)).collect()] == ["v9"]


# --------------------------------------------------------------- reload ---

def test_reload_from_itself(spark, base):
    TB.reload_table(spark.createDataFrame([("a", 1)], "k string, n int"), base)
    reader = TB.read_table(spark, base)
    for n in (2, 3):
        old = TB.read_table(spark, base)
        assert TB.reload_table(old.withColumn("n", F.col("n") + 1), base) == n
        assert TB.read_table(spark, base).first().n == n
        if n == 2:
            assert reader.first().n == 1                              # a reader of the version before goes on
    assert files.entries(spark, base) == ["version=2", "version=3"]
    with pytest.raises(Exception, match="bad"):
        TB.reload_table(old.withColumn("n", F.raise_error(F.lit("bad")).cast("int")), base)
    assert TB.read_table(spark, base).first().n == 3 and files.entries(spark, base) == ["version=2", "version=3"]
    TB.register_path(spark, "tg_reloaded", base)
    assert spark.table("tg_reloaded").first().n == 3


# -------------------------------------------------------------- run ids ---

def test_two_drivers_never_share_a_run(spark, base):
    one, two = L.Warehouse(base), L.Warehouse(base)
    a = [r.run_id for r in L.start_runs(spark, one, [5, 6])]
    b = [r.run_id for r in L.start_runs(spark, two, [5])]
    assert a == [1, 2] and b == [3]
    files.create_exclusive(spark, f"{base}/control/run_ids/4")        # another driver, after we have looked
    known = files.entries
    try:
        files.entries = lambda s, f: [n for n in known(s, f) if n != "4"]
        assert [r.run_id for r in L.start_runs(spark, one, [7, 8], "2024-01-01 00:00:00")] == [5, 6]
    finally:
        files.entries = known
    assert not files.create_exclusive(spark, f"{base}/control/run_ids/4")


def test_start_ids_go_on_from_the_ledger(spark):
    events = K.event(spark, 41, 2, 1, K.START)
    starts = spark.createDataFrame([("b",), ("a",), (None,)], "p string")
    got = {r.p: r.run_id for r in K.run_start_ids(events, starts, ["p"]).collect()}
    assert got == {None: 42, "a": 43, "b": 44}
    assert K.run_start_ids(events.limit(0), starts, ["p"]).agg(F.max("run_id")).first()[0] == 3


# ---------------------------------------------------------------- zones ---

NY = "America/New_York"


def test_stamps_of_clock_changes(spark):
    rows = [("twice", dt.datetime(2024, 11, 3, 1, 30)), ("never", dt.datetime(2024, 3, 10, 2, 30)),
            ("plain", dt.datetime(2024, 7, 1, 12, 0)), ("none", None), ("edge", dt.datetime(2024, 11, 3, 2, 0)),
            ("first", dt.datetime(2024, 11, 3, 1, 0))]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz")
    got = {r.k: r for r in df.select("k", Z.instant_of("t", NY).alias("early"), Z.instant_of("t", NY, Z.LATER).alias("late"),
                                     Z.instant_of("t", NY, skipped=Z.NULL).alias("strict"), Z.is_repeated("t", NY).alias("twice"),
                                     Z.is_skipped("t", NY).alias("never")).collect()}
    assert (got["twice"].early, got["twice"].late) == (dt.datetime(2024, 11, 3, 5, 30), dt.datetime(2024, 11, 3, 6, 30))
    assert got["never"].early == dt.datetime(2024, 3, 10, 7, 30) and got["never"].strict is None
    assert got["plain"].early == got["plain"].late == got["plain"].strict == dt.datetime(2024, 7, 1, 16, 0)
    assert got["edge"].early == got["edge"].late == dt.datetime(2024, 11, 3, 7, 0) and got["first"].twice
    assert got["none"].early is None
    assert [k for k, r in got.items() if r.twice] == ["twice", "first"] and [k for k, r in got.items() if r.never] == ["never"]


@pytest.mark.parametrize("zone", [NY, "America/Sao_Paulo", "Asia/Kolkata", "Australia/Lord_Howe", "Europe/Berlin"])
def test_every_hour_of_two_years(spark, zone):
    start = dt.datetime(2017, 6, 1)
    hours = [start + dt.timedelta(minutes=30 * i) for i in range(2 * 24 * 730)]
    df = spark.createDataFrame([(h,) for h in hours], "u timestamp_ntz").withColumn("w", Z.wall_clock("u", zone))
    got = df.select("u", "w", Z.instant_of("w", zone).alias("a"), Z.instant_of("w", zone, Z.LATER).alias("b"),
                    Z.is_skipped("w", zone).alias("s")).collect()
    for r in got:
        aware = r.u.replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(zone))
        assert r.w == aware.replace(tzinfo=None) and not r.s
        assert r.u in (r.a, r.b) and r.u == (r.b if aware.fold else r.a)


def test_ilike_lookup(spark):
    p = spark.createDataFrame([(2, "Fin_1", "raw", "s", "A"), (1, "FinX1", "raw", "s", "A"), (0, "Fin_1", "raw", "s", "I")],
                              "process_id long, process_name string, step_name string, source_system string, status string")
    assert K.process_lookup(p, "fin_1", "RAW", "S").first().process_id == 2
    assert K.process_lookup(p, "fin_1", "r%", "S", use_ilike=True).first().process_id == 1
