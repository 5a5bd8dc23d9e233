import uuid

import pytest
from pyspark.sql import functions as F

from tollgate.operators import history as H
from tollgate.plans import registry as G
from tollgate.session import checkpoint_dir
from tollgate.sources import files
from tollgate.sources import testdata as TD
from tollgate.sources.history_store import HistoryStore, RunInUse

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def rows(spark, month_vals, tag):
    return spark.createDataFrame([(m, f"{tag}{i}") for i, m in enumerate(month_vals)],
                                 "posting_month string, v string")


def key(r):
    return (r.posting_month, r.v, str(r.valid_from), str(r.valid_to), r.is_current)


def test_stored_equals_derived(spark):
    r1, r2, r3 = rows(spark, ["m1", "m2", None], "a"), rows(spark, ["m2"], "b"), rows(spark, ["m1", "m2"], "c")
    h = H.stamp_history(r1, T1)
    h = H.expire_and_append(h, r2, ["posting_month"], T2)
    h = H.expire_and_append(h, r3, ["posting_month"], T3)
    stored = sorted(map(key, h.collect()), key=repr)
    parts = [r.select("*", F.lit(i).cast("bigint").alias("run_id"), H.as_timestamp(t).alias("valid_from"))
             for i, (r, t) in enumerate([(r1, T1), (r2, T2), (r3, T3)], 1)]
    raw = parts[0].unionByName(parts[1]).unionByName(parts[2])
    derived = sorted(map(key, H.derive_validity(raw, ["posting_month"]).collect()), key=repr)
    assert stored == derived
    # the NULL-month row never expires
    assert [k for k in stored if k[0] is None][0][4] is True


def test_expire_all(spark):
    h = H.expire_all(H.stamp_history(rows(spark, ["m1"], "a"), T1), T2)
    r = h.first()
    assert r.is_current is False and str(r.valid_to) == "2024-02-01 00:00:00"


def test_store_first_load_append_retry(spark):
    store = HistoryStore(spark, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}", ["posting_month"])
    assert not store.exists()
    store.append(rows(spark, ["m1", "m2"], "a"), 1, T1)
    store.append(rows(spark, ["m2"], "b"), 2, T2)
    store.append(rows(spark, ["m2"], "b"), 2, T2)  # retried run replaces its own partition
    cur = sorted((r.posting_month, r.v) for r in store.current().collect())
    assert cur == [("m1", "a0"), ("m2", "b0")]
    assert store.read().count() == 3


def test_empty_load_supersedes_nothing(spark):
    store = HistoryStore(spark, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}")
    store.append(rows(spark, ["m1"], "a"), 1, T1)
    store.append(rows(spark, ["m1"], "a").limit(0), 2, T2)
    assert store.current().count() == 1


def test_append_merge_schema(spark):
    a = spark.createDataFrame([("x",)], "p string")
    b = spark.createDataFrame([("y", 1)], "p string, q int")
    out = H.append_merge_schema(a, b)
    assert out.columns == ["p", "q"] and out.filter(F.col("q").isNull()).count() == 1


def test_retry_replaces_the_whole_run(spark):
    store = HistoryStore(spark, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}")
    store.append(rows(spark, ["m1"], "a"), 1, T1, "x")
    store.append(rows(spark, ["m1"], "a").limit(0), 1, T1, "x")      # the retry rejects the row
    assert store.read().count() == 0 and store.current().count() == 0


def test_empty_first_load_can_be_read(spark):
    store = HistoryStore(spark, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}", ["posting_month"])
    store.append(rows(spark, ["m1"], "a").limit(0), 1, T1)
    assert store.exists() and store.current().columns[:2] == ["posting_month", "v"]
    assert store.current().count() == 0


def test_foreign_run_id_is_refused(spark):
    store = HistoryStore(spark, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}")
    store.append(rows(spark, ["m1"], "a"), 1, T1, "delivery 1")
    with pytest.raises(RunInUse):
        store.append(rows(spark, ["m1"], "b"), 1, T1, "delivery 2")
    assert [r.v for r in store.current().collect()] == ["a0"]


def test_current_reads_surviving_runs_only(spark):
    store = HistoryStore(spark, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}")
    store.append(rows(spark, ["m1"], "a"), 1, T1)
    store.append(rows(spark, ["m1"], "b"), 2, T2)
    plan = store.current()._jdf.queryExecution().executedPlan().toString()
    assert "run_id" in plan.split("PartitionFilters: ")[1].split("]")[0]
    scoped = HistoryStore(spark, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}", ["posting_month"])
    scoped.append(rows(spark, ["m1", "m2"], "a"), 1, T1)
    scoped.append(rows(spark, ["m1", "m2"], "b"), 2, T2)
    scoped.append(rows(spark, ["m2"], "c"), 3, T3)
    plan = scoped.current()._jdf.queryExecution().executedPlan().toString()
    assert "(run_id" in plan and ">= 2)" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert sorted(r.v for r in scoped.current().collect()) == ["b0", "c0"]


def test_new_columns_widen_the_spec(spark):
    store = HistoryStore(spark, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}", ["posting_month"])
    store.append(rows(spark, ["m1"], "a"), 1, T1)
    store.append(rows(spark, ["m2"], "b").withColumn("more", F.lit(7)), 2, T2)
    assert sorted((r.v, r.more) for r in store.read().collect()) == [("a0", None), ("b0", 7)]


def test_a_listed_scope_leaves_the_history_where_it_is(spark):
    first, second = rows(spark, ["m1", "m2", "m2", None], "a"), rows(spark, ["m2", "m2", "m3", None], "b")
    got, want = [H.expire_and_append(H.stamp_history(first, T1), second, ["posting_month"], T2, month_domain=known)
                 for known in (True, False)]
    assert sorted(map(key, got.collect()), key=repr) == sorted(map(key, want.collect()), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    twice = second.select("posting_month").unionByName(second.select("posting_month"))
    assert H.expire_scope(H.stamp_history(first, T1), twice, ["posting_month"], T2, listed=True).count() == 4
    none = H.expire_and_append(H.stamp_history(first, T1), second.limit(0), ["posting_month"], T2, month_domain=True)
    assert none.count() == none.filter(F.col(H.CURRENT)).count() == 4


def test_four_loads_keep_one_stored_history(spark):
    sf, kept = "/root/testdata/sf0.001", files.entries(spark, checkpoint_dir(spark))
    h = G.q_scd_expire_append(spark, sf)
    (stored,) = set(files.entries(spark, checkpoint_dir(spark))) - set(kept)      # neither replaced ones nor checkpoints
    earlier = spark.read.parquet(f"{checkpoint_dir(spark)}/{stored}")
    led = TD.ledger(spark, sf)
    assert earlier.count() == led.filter(F.col("file_name").isin(TD.LEDGER_FILES[:3])).count()
    assert h.count() == led.count()
    assert "hashpartitioning(posting_month" not in h._jdf.queryExecution().executedPlan().toString()
