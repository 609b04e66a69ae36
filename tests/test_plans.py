"""Plan-shape checks for the properties the scale design relies on."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from warehouse_data import SF_SMALL
from ledgerloom.operators import vault as V
from ledgerloom.plans.tables import stage
from ledgerloom.plans.warehouse import Warehouse


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.from_fixtures(spark, SF_SMALL)


def test_m1_hash_aggregates_and_one_window_exchange(wh):
    p = plan(wh.finance_advisor_commissions_monthly)
    assert "SortAggregate" not in p                       # string max() avoided
    assert p.count("Exchange (") + p.count("Exchange\n") >= 1
    assert "BroadcastHashJoin" in p                       # bounded calendar broadcast
    # the two windows share one exchange: exactly 2 exchanges (group-by, window)
    assert sum(1 for line in p.splitlines() if line.strip().startswith("+- Exchange")
               or line.strip().startswith(":- Exchange")) == 2


def test_insert_only_anti_join_reads_only_the_hash_column(spark, wh):
    hub = V.HUBS["hub_policy"]
    target = stage(V.hub_candidates(wh.transactions_keyed, hub, F.lit("2024-06-30 00:00:00").cast("timestamp_ntz")))
    delta = V.insert_only_delta(V.hub_candidates(wh.transactions_keyed, hub, F.current_timestamp()), target, hub.hk)
    p = plan(delta)
    scans = [line for line in p.splitlines() if "ReadSchema" in line and "/stage/" in p]
    assert any("ReadSchema: struct<policy_hk:string>" in line for line in scans)


def test_filters_reach_the_scan(spark, wh):
    df = wh.stg_commissions.where(F.col("commission_id") == "COM000000001").select("company")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(commission_id), EqualTo(commission_id,COM000000001)]" in p


def test_store_reads_one_published_folder(spark, tmp_path):
    from ledgerloom.plans.build import TableStore
    store = TableStore(spark, str(tmp_path / "s"))
    df = spark.range(10).withColumnRenamed("id", "x")
    store.write_run("t", df, "20240101T000000")
    store.write_run("t", df.where("x < 3"), "20240201T000000")
    assert store.latest("t") is None                   # nothing published yet
    store.publish("20240101T000000")
    assert store.latest("t").count() == 10
    store.publish("20240201T000000")
    latest = store.latest("t")
    assert latest.count() == 3 and store.every_run("t").count() == 13
    assert plan(latest).count("+- Scan parquet") == 1 and "Join" not in plan(latest)


def test_column_checks_scan_a_table_once(spark, tmp_path):
    from ledgerloom.operators.quality import DataTest, run_tests
    spark.range(10).selectExpr("id a", "id b", "cast(id as string) c").write.parquet(str(tmp_path / "t"))
    t = {"t": spark.read.parquet(str(tmp_path / "t"))}
    tests = [DataTest("not_null", "t", (x,), label=f"n_{x}") for x in "abc"] + [
        DataTest("accepted_values", "t", ("c",), values=("1",), where="a < 5", label="v")]
    got = run_tests(t, tests, materialise=False)
    assert plan(got).count("- Scan parquet") == 1
    assert {r.test_name: r.failures for r in got.collect()} == {"n_a": 0, "n_b": 0, "n_c": 0, "v": 4}


def test_alert_stops_at_first_hit(spark):
    from ledgerloom.operators import quarantine as Q
    q = spark.createDataFrame([("p", None)], "pipe_name string, captured_at timestamp_ntz")
    assert "Limit" in plan(Q.alert(q, "2024-01-01 00:00:00"))


def test_the_line_feeds_share_one_stored_join(spark, tmp_path):
    from ledgerloom.sources import fixtures
    from ledgerloom.sources.tables import TableSource
    t = TableSource(spark, SF_SMALL + "/")
    plans = [fixtures.stored_landing(t, shape, v).select("policy_number")._jdf.queryExecution().executedPlan().toString()
             for shape in fixtures.LINE_SHAPES for v in (0, 1)]
    assert not any("Join" in p for p in plans) and len({f for f in fixtures.stored_landing(t, "valuations").inputFiles()}
                                                       ^ set(fixtures.stored_landing(t, "investment_transactions", 1).inputFiles())) == 0
    for shape in fixtures.LINE_SHAPES:                 # the same rows as the join itself gives
        for v in (0, 1):
            rows, want = fixtures.stored_landing(t, shape, v), fixtures.SHAPE_BUILDERS[shape](t, v)
            assert rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()


def test_a_table_of_column_checks_only_is_not_written(spark, monkeypatch):
    from ledgerloom.operators import quality
    from ledgerloom.operators.quality import DataTest
    monkeypatch.setattr(quality, "stage", lambda *a: pytest.fail("a table was written"))
    t = {"t": spark.range(10).selectExpr("id a", "if(id < 3, null, id % 2) b"), "p": spark.range(1).selectExpr("id b")}
    got = quality.run_tests(t, [DataTest("not_null", "t", (x,), label=f"n_{x}") for x in "ab"])
    assert {r.test_name: r.failures for r in got.collect()} == {"n_a": 0, "n_b": 3}
    # orphans are counted by the row, though they meet their parents once a value
    for parent, failures in (({"p": t["p"]}, 4), ({"p": spark.range(2).selectExpr("id b")}, 0)):
        got = quality.run_tests(t | parent, [DataTest("relationships", "t", ("b",), to="p", field="b")], materialise=False)
        assert got.first().failures == failures
    plan_ = plan(quality.run_tests(t, [DataTest("relationships", "t", ("b",), to="p", field="b")], materialise=False))
    assert "LeftAnti" in plan_ and "HashAggregate" in plan_.split("LeftAnti")[0]


def test_a_suite_reads_every_table_once_and_writes_none(spark, tmp_path, monkeypatch):
    """All kinds of tests from one scan give what each test gives by itself."""
    from ledgerloom.operators import quality
    from ledgerloom.operators.quality import DataTest
    digest = "0123456789abcdef" * 2
    texts = [None, "", digest, digest, digest.upper(), digest.upper(), digest + "\n", "fifteen letters", "sixteen letters.",
             "sixteen letters.", "\x01", "\x00", "é", "é", digest[:15], digest[:16]]
    rows = [(s, i // 2, i % 3, f"2024-01-01 00:00:00.00000{i % 2}") for i, s in enumerate(texts)]
    spark.createDataFrame(rows, "s string, i bigint, j int, ts string").selectExpr(
        "s", "if(i = 3, null, i) i", "j", "cast(ts as timestamp_ntz) ts", "i / 2 x").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(s, i) for i, s in enumerate(texts[:7] + [None])], "s string, i bigint") \
        .write.parquet(str(tmp_path / "p"))
    t = {n: spark.read.parquet(str(tmp_path / n)) for n in "tp"}
    tests = [DataTest("not_null", "t", ("s",)), DataTest("not_null", "t", ("i",), where="j > 0", label="some"),
             DataTest("accepted_values", "t", ("j",), "warn", values=("0", "1")), DataTest("unique", "t", ("s",)),
             DataTest("unique", "t", ("i",), where="j > 0"), DataTest("unique", "t", ("ts",)), DataTest("unique", "p", ("i",)),
             *[DataTest("unique_combination_of_columns", "t", c) for c in (("s", "i"), ("i", "ts"), ("i",))],
             *[DataTest("relationships", "t", (c,), to="p", field=c) for c in "si"],
             DataTest("relationships", "t", ("s",), to="p", field="s", where="i is null", label="rs")]
    want = {tuple(r) for r in quality.run_tests(t, tests, materialise=False).collect()}
    written, write = [], quality.stage
    monkeypatch.setattr(quality, "stage", lambda df, name, **o: written.append((name, df)) or write(df, name, **o))
    got = quality.run_tests(t, tests)
    assert {tuple(r) for r in got.collect()} == want and len(want) == len(tests)
    assert [n for n, _ in written] == ["test-results"] and plan(written[0][1]).count("- Scan parquet") == 2
    # a column of fractions is compared as it is
    own = [DataTest("unique", "t", ("x",)), DataTest("relationships", "t", ("j",), to="p", field="i")]
    assert {tuple(r) for r in quality.run_tests(t, own).collect()} == {tuple(r) for r in quality.run_tests(t, own, False).collect()}


def test_a_parent_is_marked_once_for_all_its_tests_and_a_row_once_for_all_its_checks(spark):
    from ledgerloom.operators import quality
    from ledgerloom.operators.quality import DataTest
    parent = spark.range(10).selectExpr("md5(cast(id as string)) AS k")
    child = spark.range(30).selectExpr("md5(cast(id % 12 as string)) AS k", "md5(cast(id % 3 as string)) AS j",
                                       "cast(null as string) AS a", "if(id < 4, null, 'x') AS b")
    tests = [DataTest("unique", "p", ("k",)), DataTest("not_null", "p", ("k",)),
             *[DataTest("relationships", "t", (c,), to="p", field="k") for c in "kj"],
             DataTest("relationships", "t", ("k",), to="p", field="k", where="b is null", label="few"),
             DataTest("unique", "p", ("k",), where="k > '5'", label="own"),
             *[DataTest("not_null", "t", (c,)) for c in "kab"], DataTest("accepted_values", "t", ("b",), values=("y",), label="v")]
    tables = {"p": parent, "t": child}
    places, families = quality._places(tests)
    marks = {n: quality._marks(tables, n, tests, places, families) for n in tables}
    assert marks["p"].where("slot = 0").groupBy("family").count().where("count = 10").count() == 1
    assert marks["p"].count() == 10 + parent.where("k > '5'").count()
    assert marks["t"].count() == 30 + 30 + 4 + 30
    got = {r.test_name: r.failures for r in quality.run_tests(tables, tests).collect()}
    assert got == {"unique_p_k": 0, "not_null_p_k": 0, "relationships_t_k": 4, "relationships_t_j": 0, "few": 0, "own": 0,
                   "not_null_t_k": 0, "not_null_t_a": 30, "not_null_t_b": 4, "v": 26}


def test_more_checks_than_a_mask_holds(spark):
    from ledgerloom.operators import quality
    from ledgerloom.operators.quality import DataTest
    rows = spark.range(7).selectExpr("id", *[f"if(id = {i % 7}, null, id) AS c{i}" for i in range(130)])
    tests = [DataTest("unique", "t", ("id",))] + [DataTest("not_null", "t", (f"c{i}",)) for i in range(130)]
    got = quality.run_tests({"t": rows}, tests).collect()
    assert len(got) == 131 and all(r.failures == int(r.test_name != "unique_t_id") for r in got)
