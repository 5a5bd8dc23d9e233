import uuid

import pytest

from tollgate.functions.rules import NOT_NULL, Rule
from tollgate.plans import loads as L
from tollgate.session import checkpoint_dir
from tollgate.sources import delimited as DL
from tollgate.streaming.landing import start_bronze_stream

SPEC = DL.ReaderSpec(prefix="led", extension="txt")
RULES = [Rule(1, "v", NOT_NULL, reject_all=True), Rule(2, "k", NOT_NULL)]
A, B = "led_20240101_120000.txt", "led_20240102_120000.txt"


def part(spark, landing, name, rows):
    spark.createDataFrame(rows, "k string, v string").coalesce(1).write.mode("append").option(
        "sep", "\t").csv(f"{landing}/{name}")


def done(spark, landing, name):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{landing}/{name}.done")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(49)
    out.close()


def trigger(spark, wh, base):
    start_bronze_stream(spark, wh, "t", f"{base}/landing", ["k", "v"], SPEC, RULES, 2, f"{base}/ckpt").awaitTermination(120)


def state(spark, wh):
    return (sorted((r.file_name, r.k) for r in wh.bronze(spark, "t").current().collect()),
            sorted((r.file_name, r.k, r.reject_reasons) for r in wh.bronze_rejected(spark, "t").current().collect()))


@pytest.fixture()
def base(spark):
    return f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


def test_parts_over_two_triggers_are_one_extract(spark, base):
    wh = L.Warehouse(f"{base}/wh", ["file_name"])
    part(spark, f"{base}/landing", A, [("a", "1")])
    trigger(spark, wh, base)                                    # no marker yet: nothing is read
    assert not wh.bronze(spark, "t").exists()
    part(spark, f"{base}/landing", A, [("b", None)])
    done(spark, f"{base}/landing", A)
    trigger(spark, wh, base)
    assert state(spark, wh) == ([], [(A, "a", "1"), (A, "b", "1")])   # the late part's fault rejects the extract
    trigger(spark, wh, base)                                    # nothing new
    assert wh.bronze_rejected(spark, "t").raw().count() == 2


def test_two_extracts_over_two_triggers_end_like_the_batch_load(spark, base):
    wh = L.Warehouse(f"{base}/wh", ["file_name"])
    for name, rows in ((A, [("a", "1"), (None, "2")]), (B, [("c", "3")])):
        part(spark, f"{base}/landing", name, rows)
        done(spark, f"{base}/landing", name)
        trigger(spark, wh, base)
    batch = L.Warehouse(f"{base}/batch", ["file_name"])
    L.bronze_load(spark, batch, "t", f"{base}/landing", ["k", "v"], SPEC, RULES, L.RunInfo(1, 2, "2024-01-01 00:00:00"))
    assert state(spark, wh) == state(spark, batch) == ([(A, "a"), (B, "c")], [(A, None, "2")])


def test_needs_history_by_extract(spark, base):
    with pytest.raises(ValueError):
        trigger(spark, L.Warehouse(f"{base}/wh"), base)
