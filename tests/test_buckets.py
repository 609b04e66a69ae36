"""Keyed tables: a run opens and rewrites only the buckets its keys fall into."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import scd
from ledgerloom.plans.buckets import BucketState, KeySet, append_versions, bucket_of
from ledgerloom.plans.build import TableStore, read_snapshot, take_snapshot

RUNS = ["20240101T000000", "20240201T000000", "20240301T000000"]


def ts(run):
    return F.lit(f"{run[:4]}-{run[4:6]}-{run[6:8]} 00:00:00").cast("timestamp_ntz")


def keys(spark, low, high):
    return spark.range(low, high).select(F.md5(F.col("id").cast("string")).alias("hk"), F.col("id").alias("v"))


def test_one_percent_of_new_keys_opens_few_buckets(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), buckets=64)
    hub = KeySet(store, "hub", "hk")
    hub.append(keys(spark, 0, 20_000), RUNS[0])
    store.publish(RUNS[0])
    whole = len(store.every_run("hub").inputFiles())
    fresh = keys(spark, 20_000, 20_200).withColumn("_bucket", bucket_of("hk", 64))
    opened = hub.opened(fresh, RUNS[1])
    assert len(opened) < 0.1 * 64
    stored = hub.stored(RUNS[1], opened)
    if stored is not None:
        plan = stored._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [_bucket" in plan and len(opened) < 0.1 * whole
    # all of the known keys come again with the new ones: exact, nothing twice
    for _ in range(2):                                 # and once more, a retried run
        hub.append(keys(spark, 0, 20_200), RUNS[1])
    assert store.current("hub", RUNS[1]).agg(F.min("v"), F.max("v"), F.count("v")).first()[:] == (20_000, 20_199, 200)
    store.publish(RUNS[1])
    hub.append(keys(spark, 100, 300), RUNS[2])         # nothing new: an empty run
    store.publish(RUNS[2])
    assert store.every_run("hub").select("hk").distinct().count() == store.every_run("hub").count() == 20_200


def test_a_full_sketch_stays_exact(spark, tmp_path):
    """One bucket, so small a sketch that nearly every key looks stored."""
    store = TableStore(spark, str(tmp_path / "s"), buckets=1)
    hub = KeySet(store, "hub", "hk")
    for i, run in enumerate(RUNS):
        hub.append(keys(spark, 0, 60_000 * (i + 1)), run)
        store.publish(run)
    assert store.every_run("hub").select("hk").distinct().count() == store.every_run("hub").count() == 180_000


def test_versions_compare_with_the_latest_only_and_never_read_history(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "s"), buckets=8)
    monkeypatch.setattr(TableStore, "every_run", lambda *a, **k: pytest.fail("history was read"))

    def rows(values, run):
        return spark.createDataFrame(values, "hk string, hashdiff string").select("hk", ts(run).alias("load_dts"), "hashdiff")
    runs = [[("k1", "A"), ("k2", "X"), ("k2", "Y")], [("k1", "B"), ("k2", "X"), ("k3", "N")], [("k1", "A"), ("k3", "N")]]
    deltas = []
    for run, values in zip(RUNS, runs):
        for _ in range(2):                             # each run is retried
            append_versions(store, "sat", "hk", rows(values, run), run)
        deltas.append(sorted((r.hk, r.hashdiff) for r in store.current("sat", run).collect()))
        store.publish(run)
    assert deltas == [[("k1", "A"), ("k2", "X"), ("k2", "Y")], [("k1", "B"), ("k2", "X"), ("k3", "N")], [("k1", "A")]]
    current = BucketState(store, "sat/current", "hk").read()
    assert sorted((r.hk, r.hashdiff) for r in current.collect()) == [("k1", "A"), ("k2", "X"), ("k3", "N")]


def test_unchanged_buckets_keep_their_files(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), buckets=8)
    extra = [c for c in scd.CHECK_COLUMNS if c != "policy_status"]
    state = spark.range(200).select(F.col("id").cast("string").alias("policy_sk"), F.lit("Active").alias("policy_status"),
                                    *[F.lit("same").alias(c) for c in extra])
    one = F.when(F.col("policy_sk") == "7", "Lapsed").otherwise(F.col("policy_status"))
    states = [state, state.withColumn("policy_status", one), state.unionByName(state.limit(1).withColumn("policy_sk", F.lit("new")))]
    expected = None
    table = BucketState(store, "snp_dim_policy/open", "policy_sk")
    files = lambda: {b: (r, os.path.getmtime(f)) for b, r in table.manifest().items()
                     for f in glob.glob(f"{table.folder(r)}/_bucket={b}/*.parquet")}
    seen = []
    for run, now in zip(RUNS, states):
        for _ in range(2):
            take_snapshot(store, now, ts(run), run)
        store.publish(run)
        expected = scd.snapshot_run(expected, now, ts(run)).checkpoint(eager=True)
        got, cols = read_snapshot(store), expected.columns
        assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, expected.collect()))
        seen.append(files())
    changed = [[b for b in after if after[b] != before.get(b)] for before, after in zip(seen, seen[1:])]
    assert len(changed[0]) == 1 and len(changed[1]) <= 2 and len(seen[-1]) == 8


def test_a_run_exchanges_packed_digests_and_no_whole_bucket(spark, tmp_path, monkeypatch):
    """No whole candidate, version or bucket is staged or exchanged."""
    from ledgerloom.plans import buckets
    staged, writes = [], []
    stage, write = buckets.stage, buckets.write
    monkeypatch.setattr(buckets, "stage", lambda df, name: staged.append(df.columns) or stage(df, name))
    monkeypatch.setattr(buckets, "write", lambda df, *a: writes.append(df._jdf.queryExecution().executedPlan().toString())
                        or write(df, *a))
    store = TableStore(spark, str(tmp_path / "s"), buckets=4)
    hub = KeySet(store, "hub", "hk")
    for i, run in enumerate(RUNS[:2]):
        hub.append(keys(spark, 0, 1_000 + i), run)
        versions = keys(spark, 0, 1_000).select("hk", ts(run).alias("load_dts"), "v", F.md5(F.when(
            F.col("v") == 7, F.lit(run)).otherwise(F.col("v").cast("string"))).alias("hashdiff"))
        append_versions(store, "sat", "hk", versions, run)
        store.publish(run)
    assert [r.v for r in store.current("hub", RUNS[1]).collect()] == [1_000]
    assert [r.v for r in store.current("sat", RUNS[1]).collect()] == [7]
    assert BucketState(store, "sat/current", "hk").read().count() == 1_000
    assert staged and all(set(c) <= {"_k0", "_k1"} for c in staged)
    assert writes and not any("REPARTITION_BY_COL" in p for p in writes)


def test_packed_keys_meet_only_their_equals(spark):
    from ledgerloom.plans.buckets import packed
    digest = "6162636465666768696a6b6c6d6e6f70"
    texts = [digest, digest.upper(), "abcdefghijklmnop", "", "k1", None, digest[:-1], digest + "0"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(packed("t").alias("p")).collect()
    assert len({bytes(r.p) for r in rows}) == len(texts) and len(rows[0].p) == 16


def test_the_probe_hashes_no_key_for_null_checks(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), buckets=4)
    hub = KeySet(store, "hub", "hk")
    hub.append(keys(spark, 0, 100), RUNS[0])
    store.publish(RUNS[0])
    rows = spark.range(50).selectExpr("cast(id % 9 as string) n").distinct().select(F.md5("n").alias("hk")).withColumn(
        "_bucket", bucket_of("hk", 4))
    plan = hub._maybe_stored(rows, store.latest("hub/sketch", RUNS[1]))._jdf.queryExecution().optimizedPlan().toString()
    assert not any("md5" in line for line in plan.splitlines() if "Filter" in line and "getbit" not in line)


def test_marks_leave_out_no_digest_and_few_others(spark, tmp_path):
    from ledgerloom.plans.buckets import Marks
    digest = lambda low, high: spark.range(low, high).select(F.col("id"), F.unhex(F.md5(F.col("id").cast("string"))).alias("_k0"))
    digest(0, 30_000).select("_k0").write.parquet(str(tmp_path / "k"))
    marks = Marks(spark.read.parquet(str(tmp_path / "k")))
    assert marks.blocks > 1
    assert marks.marked(digest(0, 30_000)).count() == 30_000
    others = digest(30_000, 130_000)
    wrong = marks.marked(others).count()
    assert wrong < 2_000 and marks.marked(others, False).count() == 100_000 - wrong
    digest(0, 0).select("_k0").write.parquet(str(tmp_path / "none"))
    assert Marks(spark.read.parquet(str(tmp_path / "none"))).marked(others).count() == 0


def test_many_changed_versions_are_found_without_an_exchange_of_the_rows(spark, tmp_path, monkeypatch):
    """More changes than go to every task, and bitmaps so full that they mark
    most rows: the same rows, and the payload is exchanged only if marked."""
    from ledgerloom.plans import buckets
    plans, write = [], buckets.write

    def run_twice(root):
        store = TableStore(spark, str(tmp_path / root), buckets=4)
        hub = KeySet(store, "hub", "hk")
        for i, run in enumerate(RUNS[:2]):
            rows = keys(spark, 0, 6_000 + 500 * i).select("hk", ts(run).alias("load_dts"), "v", F.md5(F.when(
                F.col("v") % 5 == 0, F.lit(run)).otherwise(F.col("v").cast("string"))).alias("hashdiff"))
            append_versions(store, "sat", "hk", rows, run)
            hub.append(keys(spark, 0, 6_000 + 500 * i), run)
            store.publish(run)
        state = BucketState(store, "sat/current", "hk").read().select("hk", "hashdiff", F.col("load_dts").cast("string"))
        return [sorted(r.v for r in store.current(t, RUNS[1]).collect()) for t in ("sat", "hub")] + [sorted(map(tuple, state.collect()))]
    few_changes = run_twice("a")
    assert few_changes[0] == [v for v in range(6_500) if v >= 6_000 or v % 5 == 0] and few_changes[1] == list(range(6_000, 6_500))
    assert len(few_changes[2]) == 6_500
    monkeypatch.setattr(buckets, "FEW", 1_000)
    monkeypatch.setattr(buckets, "write", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString())
                        or write(df, *a))
    assert run_twice("b") == few_changes
    history = [p for p in plans if "v#" in p and "_words" in p]
    assert history and all("strategy=broadcast" in p for p in history)
    monkeypatch.setattr(buckets, "FEW", 0)
    monkeypatch.setattr(buckets, "BITS_A_DIGEST", 1)
    assert run_twice("c") == few_changes
