"""Semantic layer, ad-hoc SQL guard, masking, tenant filter, quality statuses, ops."""

import os

import pytest
from pyspark.sql import functions as F

from warehouse_data import SF_SMALL
from ledgerloom.operators import governance as G
from ledgerloom.operators import serving as B
from ledgerloom.operators.quality import DataTest, run_tests
from ledgerloom.plans.semantic import SemanticModel
from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.sources import ops
from ledgerloom.sources.tables import TableSource


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.from_fixtures(spark, SF_SMALL)


def test_semantic_synonyms_and_refusal(spark, wh):
    sm = SemanticModel({"advisor_commissions_monthly": wh.finance_advisor_commissions_monthly,
                        "aum_monthly": wh.portfolio_aum_monthly, "policy_inforce": wh.risk_policy_inforce})
    out = sm.query("broker earnings", ["payout"], ["firm"])
    assert out.columns == ["company", "commission_net_total"]
    with pytest.raises(ValueError):
        sm.query("commissions", ["cumulative commissions"], ["tenant"])
    with pytest.raises(KeyError):
        sm.query("commissions", ["no such measure"])


def test_adhoc_sql_is_read_only(spark, wh):
    views = {"portfolio_aum_monthly": wh.portfolio_aum_monthly}
    assert B.adhoc_sql(spark, views, "select count(*) as n from portfolio_aum_monthly").first().n >= 0
    spark.range(3).createOrReplaceTempView("portfolio_aum_monthly")
    for bad in ("drop view portfolio_aum_monthly", "select 1; select 2", "insert into x values (1)", "set a=1",
                "with a as (select 1) insert overwrite directory '/tmp/never-written' using parquet select * from a",
                "from portfolio_aum_monthly insert overwrite directory '/tmp/never-written' using parquet select *",
                "create table t as select 1", "select transform(id) using 'cat' as (x) from portfolio_aum_monthly"):
        with pytest.raises(ValueError):
            B.adhoc_sql(spark, views, bad)
    assert not os.path.exists("/tmp/never-written")
    good = """with a as (select company, ';' as s from portfolio_aum_monthly where company in (select max(company)
              from portfolio_aum_monthly)) select s, count(*) over (partition by company) as n from a order by 1 limit 5"""
    assert B.adhoc_sql(spark, views, good).columns == ["s", "n"]
    assert spark.table("portfolio_aum_monthly").count() == 3      # the session's own view is back
    spark.catalog.dropTempView("portfolio_aum_monthly")


def test_masking_by_role(spark, wh):
    masked = G.masked_view(wh.dim_client, "FR_ANALYST")
    privileged = G.masked_view(wh.dim_client, "ACCOUNTADMIN")
    m = masked.where(F.col("birth_date").isNotNull()).first()
    assert m.client_id_number == "***MASKED***" and m.birth_date.month == 1 and m.birth_date.day == 1
    assert masked.where(F.col("client_first_name") != "***MASKED***").count() == 0   # NULLs masked too
    assert privileged.exceptAll(wh.dim_client).count() == 0
    only_mb = G.tenant_filter(wh.finance_advisor_commissions_monthly, ["MAIN_BOOK"])
    assert {r.company for r in only_mb.select("company").distinct().collect()} <= {"MAIN_BOOK"}


def test_quality_statuses(spark, wh):
    tests = [DataTest("unique", "f", ("commission_sk",)),
             DataTest("relationships", "f", ("advisor_sk",), severity="warn", to="a", field="advisor_sk"),
             DataTest("accepted_values", "f", ("company",), values=("MAIN_BOOK",))]
    res = {r.test_name: r for r in run_tests({"f": wh.fct_commissions, "a": wh.dim_advisor}, tests).collect()}
    assert res["unique_f_commission_sk"].status == "PASS"
    assert res["relationships_f_advisor_sk"].status == "WARN"      # trap 2 orphan key
    assert res["accepted_values_f_company"].status == "FAIL"


def test_ops_replication(spark):
    t = TableSource(spark, SF_SMALL)
    cur = ops.replicate_policies(t)
    assert cur.where("is_deleted").count() == 0
    assert cur.groupBy("policy_id").count().where("count > 1").count() == 0
    lapsed = cur.where("(policy_id - 1) % 10 = 1").select("status").distinct().collect()
    assert [r.status for r in lapsed] == ["LAPSED"]


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and "commission_net_total" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())


def test_balances_and_ratios_of_the_semantic_layer(spark):
    rows = [("t", "ETF", "f1", "2024-01-01", 10, 1), ("t", "ETF", "f1", "2024-02-01", 20, 2), ("t", "ETF", "f2", "2024-02-01", 5, 1),
            ("t", None, "f3", "2024-01-01", 7, 0), ("u", "ETF", "f4", "2024-03-01", None, None)]
    base = spark.createDataFrame(rows, "company string, fund_type string, fund_name string, year_month string, "
                                       "aum_amount int, unique_policies int")
    model = SemanticModel({"aum_monthly": base})
    got = {(r.company, r.fund_type): (r.closing_aum, r.aum_amount, r.aum_per_policy) for r in model.query(
        "portfolio", ["closing_aum", "AUM", "aum_per_policy"], ["tenant", "product structure"]).collect()}
    assert got == {("t", "ETF"): (25, 35, 8.75), ("t", None): (7, 7, None), ("u", "ETF"): (None, None, None)}
    total = model.query("portfolio", ["closing_aum"]).first()[0]
    assert total is None                    # the last month's only row has no value
    for bad in (["closing_aum", "aum_mom_change"], ["aum_mom_pct_change"]):
        with pytest.raises(ValueError):
            model.query("portfolio", bad, ["tenant"])


def test_distinct_sets_roll_up(spark):
    from pyspark.sql import functions as F
    from ledgerloom.operators.distincts import distinct_counts, distinct_sets
    rows = spark.range(70_000).select((F.col("id") % 3).alias("a"), (F.col("id") % 7).alias("b"), F.when(
        F.col("id") % 11 > 0, (F.col("id") % 40_000).cast("string")).alias("client"))
    rows = rows.unionByName(rows.limit(5).select(F.lit(9).alias("a"), F.lit(9).alias("b"), F.lit(None).cast("string").alias("client")))
    for parts in (1, 64):                   # one part: its clients fill more than one block
        sets = distinct_sets(rows, "client", ["a", "b"], parts)
        for dims in (["a", "b"], ["a"], ["b"], []):
            want = rows.groupBy(*dims).agg(F.count_distinct("client").alias("n")).where("n > 0")
            assert sorted(map(str, distinct_counts(sets, dims, "n").collect())) == sorted(map(str, want.collect()))


def test_masks_follow_the_lineage(spark, wh):
    clients = wh.dim_client
    view = clients.select(
        "client_sk", F.col("birth_date").alias("born"), F.year("birth_date").alias("birth_year"),
        F.date_add("birth_date", 1).alias("day_after"), F.concat("client_first_name", F.lit("!")).alias("greeting"))
    assert G.derived_columns(view, G.DIM_CLIENT_POLICY) == ["born", "birth_year", "day_after", "greeting"]
    row = G.masked_lineage(view, "FR_ANALYST").where("born is not null").first()
    assert row.birth_year is None and row.greeting == "***MASKED***" and (row.born.month, row.day_after.day) == (1, 1)
    assert G.masked_lineage(view, "ACCOUNTADMIN") is view
    totals = view.groupBy("client_sk").agg(F.max("birth_year").alias("top"), F.count("born").alias("n"))
    joined = totals.unionByName(clients.selectExpr("client_sk", "0 AS top", "1L AS n")).join(
        wh.valuations_keyed.select("client_sk", "fund_sk"), "client_sk")
    assert G.derived_columns(joined, G.DIM_CLIENT_POLICY) == ["top"]
    clients.createOrReplaceTempView("lineage_clients")
    said = spark.sql("""select fund_type, (select min(birth_date) from lineage_clients) as eldest, w, n
        from (select fund_type, row_number() over (order by fund_sk) as w, 1 as n from f)""".replace("from f)", "from values ('a', 1) t(fund_type, fund_sk))"))
    assert G.derived_columns(said, G.DIM_CLIENT_POLICY) == ["eldest"]
    exploded = view.select("client_sk", F.explode(F.split("greeting", "")).alias("letter"))
    assert G.derived_columns(exploded, G.DIM_CLIENT_POLICY) == ["letter"]
    spark.catalog.dropTempView("lineage_clients")
