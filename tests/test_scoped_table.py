import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.operators import history as H
from tollgate.session import checkpoint_dir
from tollgate.sources import files
from tollgate.sources.scoped_table import ScopedTable

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
SCHEMA = T.StructType([T.StructField("m", T.StringType()), T.StructField("v", T.StringType()),
                       T.StructField(H.VALID_FROM, T.TimestampNTZType()), T.StructField(H.VALID_TO, T.TimestampNTZType()),
                       T.StructField(H.CURRENT, T.BooleanType())])


def rows(spark, months, tag):
    return spark.createDataFrame([(m, f"{tag}{i}") for i, m in enumerate(months)], "m string, v string")


@pytest.fixture()
def table(spark):
    return ScopedTable(spark, f"{checkpoint_dir(spark)}/s-{uuid.uuid4().hex}", ["m"], SCHEMA)


def key(r):
    return (r.m, r.v, str(r.valid_from), str(r.valid_to), r.is_current)


def times(table):
    p, fs = files.hadoop_path(table.spark, table._data)
    found, out = fs.listFiles(p, True), {}
    while found.hasNext():
        f = found.next()
        if f.getPath().getName().startswith("part-"):
            out[f"{f.getPath().getParent().getName()}/{f.getPath().getName()}"] = f.getModificationTime()
    return out


def test_equals_the_transform(spark, table):
    loads = [(rows(spark, ["m1", "m2", None], "a"), T1), (rows(spark, ["m2", None], "b"), T2), (rows(spark, ["m1", "m3"], "c"), T3)]
    want = H.stamp_history(*loads[0])
    table.reload(*loads[0])
    for incoming, stamp in loads[1:]:
        want = H.expire_and_append(want, incoming, ["m"], stamp)
        table.reload(incoming, stamp)
    assert sorted(map(key, table.read().collect()), key=repr) == sorted(map(key, want.collect()), key=repr)


def test_other_folders_are_not_touched(spark, table):
    table.reload(rows(spark, ["m1", "m2", "m3", None], "a"), T1)
    before = times(table)
    table.expire(spark.createDataFrame([("m2",), ("m9",), (None,)], "m string"), T2)
    after = times(table)
    assert {k: v for k, v in before.items() if not k.startswith("m=m2/")} == {
        k: v for k, v in after.items() if not k.startswith("m=m2/")}
    assert set(before) != set(after)
    assert sorted((r.m or "", r.is_current) for r in table.read().collect()) == [("", True), ("m1", True), ("m2", False), ("m3", True)]
    table.expire(spark.createDataFrame([("m9",)], "m string"), T3)   # nothing to do
    assert times(table) == after


def test_a_lost_driver_leaves_a_whole_rewrite(spark, table, monkeypatch):
    table.reload(rows(spark, ["m1", "m2"], "a"), T1)

    def lost(self):
        raise RuntimeError("lost")

    monkeypatch.setattr(ScopedTable, "_replace", lost)
    with pytest.raises(RuntimeError):
        table.reload(rows(spark, ["m2", "m3"], "b"), T2)
    monkeypatch.undo()
    want = [("m1", "a0", True), ("m2", "a1", False), ("m2", "b0", True), ("m3", "b1", True)]
    seen = lambda: sorted((r.m, r.v, r.is_current) for r in table.read().collect())
    assert seen() == want                                            # decided, so it is seen
    files.remove(spark, f"{table._data}/m=m2")                       # half replaced
    assert seen() == want
    table.reload(rows(spark, ["m4"], "c"), T3)                       # the next writer finishes it
    assert seen() == [*want, ("m4", "c0", True)]
    assert not files.exists(spark, table._pending)


def test_a_rewrite_that_fails_before_it_is_decided(spark, table):
    table.reload(rows(spark, ["m1"], "a"), T1)
    bad = rows(spark, ["m1"], "b").withColumn("v", F.raise_error(F.lit("bad")).cast("string"))
    with pytest.raises(Exception, match="bad"):
        table.reload(bad, T2)
    assert [(r.v, r.is_current) for r in table.read().collect()] == [("a0", True)]
    assert files.entries(spark, table.path) == ["data"]


def test_empty_and_several_scope_columns(spark, table):
    table.reload(rows(spark, [], "a"), T1)
    assert table.read().count() == 0
    both = ScopedTable(spark, f"{checkpoint_dir(spark)}/s-{uuid.uuid4().hex}", ["m", "v"], SCHEMA)
    both.reload(spark.createDataFrame([("m1", "x"), ("m1", "y")], "m string, v string"), T1)
    both.expire(spark.createDataFrame([("m1", "x")], "m string, v string"), T2)
    assert sorted((r.v, r.is_current) for r in both.read().collect()) == [("x", False), ("y", True)]
    with pytest.raises(ValueError, match="lacks"):
        ScopedTable(spark, "x", ["absent"], SCHEMA)


def test_rows_of_a_rewrite_are_written_once(spark, table, monkeypatch):
    written, clustered = [], ScopedTable._clustered
    monkeypatch.setattr(ScopedTable, "_clustered", lambda self, rows: written.append(1) or clustered(self, rows))
    table.reload(rows(spark, ["m1", "m2"], "a"), T1)
    table.reload(rows(spark, ["m2"], "b"), T2)
    assert len(written) == 2
    assert not files.exists(spark, table._pending)


@pytest.mark.parametrize("cols", [["m"], ["m", "v"]])
@pytest.mark.parametrize("step", ["remove", "rename"])
def test_a_driver_lost_between_two_folders(spark, monkeypatch, cols, step):
    table = ScopedTable(spark, f"{checkpoint_dir(spark)}/s-{uuid.uuid4().hex}", cols, SCHEMA)
    table.reload(rows(spark, ["m 1/%", None, "m3"], "a"), T1)
    done, real = [], getattr(files, step)

    def lost(spark, *paths):
        moved = paths[-1].startswith(f"{table._data}/")
        if moved and done:
            raise RuntimeError("lost")
        if moved:
            done.append(paths)
        return real(spark, *paths)

    monkeypatch.setattr(files, step, lost)
    with pytest.raises(RuntimeError):
        table.reload(rows(spark, ["m 1/%", None, "m3"], "a"), T2)
    monkeypatch.undo()
    assert len(done) == 1
    seen = lambda: sorted((str(r.m), r.v, r.is_current) for r in table.read().collect())
    want = sorted([("m 1/%", "a0", False), ("m 1/%", "a0", True), ("None", "a1", True), ("None", "a1", True),
                   ("m3", "a2", False), ("m3", "a2", True)])
    assert seen() == want
    table.recover()
    assert seen() == want and not files.exists(spark, table._pending)


def test_an_expiry_shuffles_no_row_for_its_scopes(spark, table, monkeypatch):
    plans, real = [], ScopedTable._rewrite
    monkeypatch.setattr(ScopedTable, "_rewrite", lambda self, rows: plans.append(
        rows._jdf.queryExecution().executedPlan().toString()) or real(self, rows))
    table.reload(rows(spark, ["m1", None], "a"), T1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table.expire(rows(spark, ["m1"], "x"), T2)
        table.reload(rows(spark, ["m1"], "b"), T3)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in plans[1:])
    assert sorted((r.m or "", r.v, r.is_current) for r in table.read().collect()) == [
        ("", "a1", True), ("m1", "a0", False), ("m1", "b0", True)]
