import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.session import checkpoint_dir
from tollgate.sources import files
from tollgate.sources.history_store import HistoryStore, TypeChange
from tollgate.sources.widening import widened, widest

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
I, L, D, S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


def store_at(spark, scope=("m",)):
    return HistoryStore(spark, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}", list(scope))


def rows(spark, values, kind):
    return spark.createDataFrame([(f"m{i}", v) for i, v in enumerate(values)], f"m string, v {kind}")


@pytest.mark.parametrize(("known", "incoming", "want"), [
    (I, L, L), (L, I, L), (T.ShortType(), T.ByteType(), T.ShortType()), (I, T.DecimalType(15, 2), T.DecimalType(15, 2)),
    (T.DecimalType(5, 0), L, T.DecimalType(19, 0)), (T.DecimalType(15, 2), T.DecimalType(12, 4), T.DecimalType(17, 4)),
    (T.DecimalType(38, 0), T.DecimalType(10, 5), None), (T.FloatType(), D, D), (I, D, D), (L, D, None), (S, I, S), (I, S, None),
    (S, T.BinaryType(), None), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.DateType(), T.TimestampType(), None),
    (T.BooleanType(), I, None), (T.NullType(), I, I), (I, T.NullType(), I), (T.ArrayType(I), T.ArrayType(L), T.ArrayType(L)),
    (T.ArrayType(I), T.ArrayType(S), None)])
def test_widest_types(known, incoming, want):
    assert widest(known, incoming) == want


def test_widened_names_what_it_refuses():
    known = T.StructType([T.StructField("a", I), T.StructField("b", S)])
    with pytest.raises(TypeChange, match="a: int to string"):
        widened(known, T.StructType([T.StructField("a", S), T.StructField("c", I)]))
    with pytest.raises(TypeChange, match="b"):
        widened(known, T.StructType([T.StructField("b", I)]), ["b"])
    assert widened(known, T.StructType([T.StructField("c", I), T.StructField("a", L)])).simpleString() == "struct<a:bigint,b:string,c:int>"


def test_widening_reads_old_and_new_files(spark):
    store = store_at(spark)
    store.append(rows(spark, [1, 2], "int"), 1, T1)
    store.append(rows(spark, [2 ** 40], "bigint"), 2, T2)
    store.append(rows(spark, [Decimal("1.25")], "decimal(10,2)"), 3, T3)
    store.append(rows(spark, [7], "smallint").withColumn("more", F.lit("x")), 4, "2024-04-01 00:00:00")
    assert store.schema()["v"].dataType == T.DecimalType(21, 2)
    got = sorted((r.run_id, r.m, r.v, r.more) for r in store.read().collect())
    assert got == [(1, "m0", Decimal("1.00"), None), (1, "m1", Decimal("2.00"), None), (2, "m0", Decimal(2 ** 40), None),
                   (3, "m0", Decimal("1.25"), None), (4, "m0", Decimal("7.00"), "x")]
    assert sorted((r.m, r.v) for r in store.current().collect()) == [("m0", Decimal("7.00")), ("m1", Decimal("2.00"))]
    # runs whose files agree are one scan: the later ones are written in the table's type
    assert store.raw()._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 3


def test_known_text_takes_numbers(spark):
    store = store_at(spark)
    store.append(rows(spark, ["a"], "string"), 1, T1)
    store.append(rows(spark, [5], "int"), 2, T2)
    assert sorted((r.run_id, r.v) for r in store.read().collect()) == [(1, "a"), (2, "5")]


def test_a_refused_change_leaves_everything_as_it_was(spark):
    store = store_at(spark)
    store.append(rows(spark, [1], "int"), 1, T1)
    before = {k: files.entries(spark, store._part(k)) for k in ("data", "scopes", "runs", "written", "layouts", "spec")}
    with pytest.raises(TypeChange):
        store.append(rows(spark, ["x"], "string"), 2, T2)
    with pytest.raises(TypeChange):                       # the scope is part of the folders
        store.append(spark.createDataFrame([(1, 1)], "m int, v int"), 2, T2)
    assert before == {k: files.entries(spark, store._part(k)) for k in before}
    assert [(r.m, r.v) for r in store.read().collect()] == [("m0", 1)]
    store.append(rows(spark, [3], "int"), 2, T2)           # its run id is still free
    assert [r.v for r in store.current().collect()] == [3]


def test_a_run_that_breaks_off_is_not_seen(spark, monkeypatch):
    store = store_at(spark)
    store.append(rows(spark, [1], "int"), 1, T1)

    def broken(self, out, run_id):
        real(self, out, run_id)
        raise RuntimeError("lost")

    real = HistoryStore._write
    monkeypatch.setattr(HistoryStore, "_write", broken)
    with pytest.raises(RuntimeError):
        store.append(rows(spark, [2 ** 40], "bigint"), 2, T2)
    monkeypatch.undo()
    assert [(r.m, r.v) for r in store.current().collect()] == [("m0", 1)] and store.read().count() == 1
    store.append(rows(spark, [2 ** 40], "bigint"), 2, T2)  # the retry
    assert [r.v for r in store.current().collect()] == [2 ** 40] and store.read().count() == 2


def test_runs_of_an_open_load_are_not_seen(spark):
    ended = {1}
    store = HistoryStore(spark, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}", ["m"], lambda: ended)
    store.append(rows(spark, [1], "int"), 1, T1)
    store.append(rows(spark, [2], "int"), 2, T2)
    assert [(r.v, r.is_current) for r in store.read().collect()] == [(1, True)]
    ended.add(2)
    assert [r.v for r in store.current().collect()] == [2]


def data_files(spark, store, run):
    p, fs = files.hadoop_path(spark, store._run_part("data", run))
    found, sizes = fs.listFiles(p, True), []
    while found.hasNext():
        f = found.next()
        if f.getPath().getName().startswith("part-"):
            sizes.append((f.getPath().getParent().getName(), f.getLen()))
    return sizes


def test_files_follow_bytes_not_tasks(spark):
    """Fifty small months and a hot one, from 64 tasks."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), (F.col("id") % 50).cast("string")))
    wide = spark.range(0, 300_000, numPartitions=64).select(hot.alias("m"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    key, advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 1 << 20
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(advisory))
    try:
        store = store_at(spark)
        store.append(wide, 1, T1)
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
    sizes = data_files(spark, store, 1)
    months = {m for m, _ in sizes}
    total = sum(n for _, n in sizes)
    assert len(months) == 51
    assert len(sizes) <= len(months) + 8 * total / advisory          # by tasks it would be thousands
    hot_files = [n for m, n in sizes if m == "m=hot"]
    assert len(hot_files) > 2 and max(hot_files) < 0.6 * sum(hot_files)  # one task does not write the hot month
    assert store.current().count() == 300_000
