"""Two- and three-run behaviour of the insert-only vault and the SCD-2 snapshot."""

from pyspark.sql import functions as F

from warehouse_data import SF_SMALL
from ledgerloom.operators import scd
from ledgerloom.operators import vault as V
from ledgerloom.plans.warehouse import Warehouse

RUN1, RUN2, RUN3 = "2024-06-30 00:00:00", "2024-07-31 00:00:00", "2024-08-31 00:00:00"


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_hub_rerun_adds_nothing(spark):
    w = Warehouse.from_fixtures(spark, SF_SMALL)
    for hub in V.HUBS.values():
        first = V.hub_candidates(w.fct_transactions, hub, ts(RUN1)).checkpoint(eager=True)
        again = V.insert_only_delta(V.hub_candidates(w.fct_transactions, hub, ts(RUN2)), first, hub.hk)
        assert again.count() == 0
        assert first.select(hub.hk).distinct().count() == first.count()


def test_satellite_guard_compares_to_latest_only(spark):
    schema = "transaction_hk string, status string"

    def src(status, ts):
        df = spark.createDataFrame([("h1", status), ("h2", "X")], schema)
        return V.satellite_source(
            df.withColumn("company", F.lit("C")).withColumn("transaction_id", F.col("transaction_hk"))
              .withColumn("_row_in_grain", F.lit(1)), ["status"], ts)

    s1 = V.satellite_delta(src("A", ts(RUN1)), None)
    s1 = s1.checkpoint(eager=True)
    assert s1.count() == 2
    unchanged = V.satellite_delta(src("A", ts(RUN2)), s1)
    assert unchanged.count() == 0
    s2 = s1.unionByName(V.satellite_delta(src("B", ts(RUN2)), s1)).checkpoint(eager=True)
    assert s2.count() == 3
    s3 = s2.unionByName(V.satellite_delta(src("A", ts(RUN3)), s2))
    assert s3.count() == 4          # A -> B -> A appends twice


def test_satellite_guard_exchanges_source_and_history_once_and_digests_packed(spark):
    rows = spark.range(3_000).selectExpr("'C' AS company", "concat('t', id % 2000) AS transaction_id", "id % 7 AS status")
    first = V.satellite_source(rows, ["status"], ts(RUN1)).checkpoint(eager=True)
    odd = F.when(F.col("transaction_id").like("%3"), 9).otherwise(F.col("status"))
    second = V.satellite_source(rows.withColumn("status", odd), ["status"], ts(RUN2))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        delta = V.satellite_delta(second, first)
        plan = delta._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(str, delta.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 2
    latest = {}
    for r in first.collect():
        latest[r.transaction_hk] = max(latest.get(r.transaction_hk, ""), r.hashdiff)
    want = [r for r in second.collect() if latest.get(r.transaction_hk) != r.hashdiff]
    assert got == sorted(map(str, want)) and 0 < len(want) < 3_000


def test_repeated_ids_reappend_unless_collapsed(spark):
    w = Warehouse.from_fixtures(spark, SF_SMALL)
    cols = V.SAT_AMOUNTS_COLUMNS
    first = V.satellite_source(w.fct_transactions, cols, ts(RUN1)).checkpoint(eager=True)
    again = V.satellite_delta(V.satellite_source(w.fct_transactions, cols, ts(RUN2)), first)
    # trap 11: keys with several different payloads keep re-appending
    dup_keys = first.groupBy("transaction_hk").agg(F.countDistinct("hashdiff").alias("n")).where("n > 1").count()
    assert (again.count() > 0) == (dup_keys > 0)
    fixed1 = V.satellite_source(w.transactions_numbered, cols, ts(RUN1), collapse=True).checkpoint(eager=True)
    fixed2 = V.satellite_delta(V.satellite_source(w.transactions_numbered, cols, ts(RUN2), collapse=True), fixed1)
    assert fixed2.count() == 0
    assert fixed1.groupBy("transaction_hk", "load_dts").count().where("count > 1").count() == 0


def test_snapshot_three_runs(spark):
    base = Warehouse.from_fixtures(spark, SF_SMALL, run_ts="2024-06-30 00:00:00")
    changed = Warehouse.from_fixtures(spark, SF_SMALL, variant=1, run_ts="2024-07-31 00:00:00")
    s1 = scd.snapshot_run(None, base.dim_policy, ts(RUN1)).checkpoint(eager=True)
    s2 = scd.snapshot_run(s1, changed.dim_policy, ts(RUN2)).checkpoint(eager=True)
    s3 = scd.snapshot_run(s2, changed.dim_policy, ts(RUN3)).checkpoint(eager=True)
    n_changed = s2.where(F.col("dbt_valid_to").isNotNull()).count()
    assert n_changed > 0
    # the second run also brings new keys, which open a version each
    n_new = changed.dim_policy.join(s1, "policy_sk", "left_anti").count()
    assert n_new > 0 and s2.count() == s1.count() + n_changed + n_new
    assert s3.count() == s2.count()                      # unchanged rerun: untouched
    open_per_key = s3.where(F.col("dbt_valid_to").isNull()).groupBy("policy_sk").count()
    assert open_per_key.where("count != 1").count() == 0  # exactly one open version per key
    hist = scd.dim_policy_history(s3)
    assert scd.policy_as_of(hist, "2024-07-15 00:00:00").count() == s1.count()


def test_point_in_time_join_picks_the_version_valid_then(spark):
    history = spark.createDataFrame(
        [("p1", "A", "2024-01-01 00:00:00", "2024-02-01 00:00:00"),
         ("p1", "B", "2024-02-01 00:00:00", "9999-12-31 00:00:00"),
         ("p2", "C", "2024-03-01 00:00:00", "9999-12-31 00:00:00")],
        "policy_sk string, policy_status string, valid_from string, valid_to string",
    ).select("policy_sk", "policy_status", F.col("valid_from").cast("timestamp_ntz").alias("valid_from"),
             F.col("valid_to").cast("timestamp_ntz").alias("valid_to"))
    facts = spark.createDataFrame(
        [("f1", "p1", "2024-01-15 00:00:00"), ("f2", "p1", "2024-02-01 00:00:00"),
         ("f3", "p2", "2024-02-15 00:00:00"), ("f4", "p9", "2024-02-15 00:00:00")],
        "fact string, policy_sk string, ts string")
    out = {r.fact: r.pit_policy_status for r in scd.point_in_time_join(facts, history, "ts").collect()}
    assert out == {"f1": "A", "f2": "B", "f3": None, "f4": None}   # every fact row kept once


def test_point_in_time_join_equals_the_range_join_on_a_hot_key(spark):
    # one key with many versions (gaps and an empty one among them), facts before, between and behind them
    history = spark.range(20_000).selectExpr(
        "if(id < 19000, 'hot', concat('k', id % 50)) AS policy_sk", "concat('s', id) AS policy_status",
        "timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id * 90) AS valid_from",
        "timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id * 90 + if(id % 7 = 0, 0, 60)) AS valid_to")
    history = history.where("policy_sk = 'hot'").unionByName(spark.range(50).selectExpr(
        "concat('k', id) AS policy_sk", "'one' AS policy_status", "timestamp_ntz'2020-03-01 00:00:00' AS valid_from",
        "timestamp_ntz'9999-12-31 00:00:00' AS valid_to"))
    facts = spark.range(6_000).selectExpr(
        "id", "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN concat('k', id % 60) END AS policy_sk",
        "if(id % 11 = 0, NULL, timestamp_ntz'2019-12-25 00:00:00' + make_interval(0, 0, 0, 0, 0, id * 400)) AS valid_from")
    got = scd.point_in_time_join(facts, history, "valid_from")
    assert got.columns == ["id", "policy_sk", "valid_from", "pit_policy_status", "pit_valid_from", "pit_valid_to"]
    h = history.alias("h")
    want = facts.alias("f").join(h, F.expr(
        "f.policy_sk = h.policy_sk AND h.valid_from <= f.valid_from AND f.valid_from < h.valid_to"), "left").select(
        "f.*", *[F.col(f"h.{c}").alias(f"pit_{c}") for c in ("policy_status", "valid_from", "valid_to")])
    key = lambda rows: sorted(map(str, rows.collect()))
    assert key(got) == key(want) and got.where("pit_policy_status is not null").count() > 1000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
