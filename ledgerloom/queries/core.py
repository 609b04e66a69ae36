"""Registered queries: staging, keys, dimensions, facts, marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..oracle import warehouse_sql  # noqa: F401  (registers CTEs)
from ..operators import facts, marts
from ..operators.numbering import Order, row_in_grain
from ..plans.warehouse import Warehouse
from ..sources.tables import TableSource


def wh(spark, sf_dir, **kw) -> Warehouse:
    return Warehouse.from_fixtures(spark, sf_dir, **kw)


# ------------------------------------------------------------------ staging
@register("t1_stg_commissions", "SELECT * EXCLUDE (dataset) FROM stg_commissions")
def t1(spark, sf):
    return wh(spark, sf).stg_commissions.drop("dataset")


@register("t2_stg_valuations", "SELECT * FROM stg_valuations")
def t2(spark, sf):
    return wh(spark, sf).stg_valuations.drop("dataset")


@register("t3_stg_investment_transactions", "SELECT * FROM stg_investment_transactions")
def t3(spark, sf):
    return wh(spark, sf).stg_investment_transactions.drop("dataset")


@register("t4_stg_risk_transactions", "SELECT * FROM stg_risk_transactions")
def t4(spark, sf):
    return wh(spark, sf).stg_risk_transactions.drop("dataset")


@register("t5_stg_risk_benefits", "SELECT * EXCLUDE (product_name) FROM stg_risk_policies WHERE company = 'MAIN_BOOK'")
def t5(spark, sf):
    w = wh(spark, sf)
    return w.stg_risk_policies.where(F.col("company") == "MAIN_BOOK").drop("dataset", "product_name")


@register("t6_stg_insurance_assurance", "SELECT * FROM stg_risk_policies WHERE company <> 'MAIN_BOOK'")
def t6(spark, sf):
    return wh(spark, sf).stg_risk_policies.where(F.col("company") != "MAIN_BOOK").drop("dataset")


# ------------------------------------------------------------------ keys
@register("k1_k2_k3_commission_keys", """
SELECT commission_sk, advisor_sk, policy_sk, date_sk FROM fct_commissions""")
def k123(spark, sf):
    return wh(spark, sf).fct_commissions.select("commission_sk", "advisor_sk", "policy_sk", "date_sk")


_NUMBERED = "SELECT company, transaction_id, CAST(_row_in_grain AS BIGINT) AS _row_in_grain, has_complete_grain FROM fct_transactions"


def _numbered(spark, sf, plain):
    return wh(spark, sf, plain_numbering=plain).transactions_numbered.select(
        "company", "transaction_id", "_row_in_grain", F.col("transaction_id").isNotNull().alias("has_complete_grain"))


@register("k5_transaction_row_in_grain", _NUMBERED)
def k5(spark, sf):
    return _numbered(spark, sf, False)


@register("k5_transaction_row_in_grain_plain", _NUMBERED)
def k5_plain(spark, sf):
    return _numbered(spark, sf, True)


@register("k5_hot_grain", """
SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey % 10 = 0
  ORDER BY CASE WHEN l_orderkey % 4 > 0 THEN DATE '2020-01-01' END ASC NULLS LAST, l_extendedprice DESC NULLS LAST,
           l_orderkey, l_linenumber) AS row_in_grain
FROM lineitem""")
def k5_hot(spark, sf):
    """One grain holds nine tenths of the rows, three quarters of them with
    one leading order value and the rest with NULL."""
    rows = TableSource(spark, sf)("lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_orderkey") % 10 == 0).alias("grain"),
        F.when(F.col("l_orderkey") % 4 > 0, F.lit("2020-01-01").cast("date")).alias("day"))
    order = [Order("day"), Order("l_extendedprice", ascending=False), Order("l_orderkey"), Order("l_linenumber")]
    return row_in_grain(rows, ["grain"], order, "row_in_grain").select("l_orderkey", "l_linenumber", "row_in_grain")


# ------------------------------------------------------------------ dims
@register("d1_dim_advisor", "SELECT * FROM dim_advisor")
def d1(spark, sf):
    return wh(spark, sf).dim_advisor


@register("d2_dim_client", "SELECT * FROM dim_client")
def d2(spark, sf):
    return wh(spark, sf).dim_client


@register("d3_dim_date", """
SELECT d.*, coalesce(c.commissions, 0) AS commissions FROM dim_date d LEFT JOIN (
  SELECT date_sk, count(*) AS commissions FROM fct_commissions GROUP BY date_sk) c ON d.date_sk = c.date_sk""")
def d3(spark, sf):
    """The calendar with the commission rows of each of its days."""
    w = wh(spark, sf)
    days = w.fct_commissions.groupBy("date_sk").agg(F.count(F.lit(1)).alias("commissions"))
    return w.dim_date.join(days, "date_sk", "left").withColumn("commissions", F.coalesce("commissions", F.lit(0)))


@register("d4_dim_fund", "SELECT * FROM dim_fund")
def d4(spark, sf):
    return wh(spark, sf).dim_fund


@register("d5_dim_policy", "SELECT * FROM dim_policy")
def d5(spark, sf):
    return wh(spark, sf).dim_policy


@register("d6_dim_product", "SELECT * FROM dim_product")
def d6(spark, sf):
    return wh(spark, sf).dim_product


# ------------------------------------------------------------------ facts
@register("f1_fct_commissions", "SELECT * FROM fct_commissions")
def f1(spark, sf):
    return wh(spark, sf).fct_commissions


@register("f1_fct_commissions_fixed", "SELECT * FROM fct_commissions_fixed")
def f1_fixed(spark, sf):
    return facts.fct_commissions(wh(spark, sf).stg_commissions, guard_advisor=True)


@register("f2_fct_valuations", "SELECT * EXCLUDE (fund_name, _row_in_grain) FROM fct_valuations")
def f2(spark, sf):
    return wh(spark, sf).fct_valuations


@register("f3_fct_transactions", "SELECT * EXCLUDE (_row_in_grain) FROM fct_transactions")
def f3(spark, sf):
    return wh(spark, sf).fct_transactions


@register("f4_fct_policies", "SELECT * FROM fct_policies")
def f4(spark, sf):
    return wh(spark, sf).fct_policies


@register("f4_fct_policies_fixed", """
SELECT f.* REPLACE (CASE WHEN a.advisor_identifier IS NOT NULL
                         THEN md5(concat_ws('-', coalesce(CAST(a.company AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
                                            coalesce(CAST(a.advisor_identifier AS VARCHAR), '_dbt_utils_surrogate_key_null_')))
                    END AS advisor_sk)
FROM fct_policies f
LEFT JOIN risk_latest_advisor a
  ON f.policy_sk = md5(concat_ws('-', coalesce(CAST(a.company AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
                                  coalesce(CAST(a.policy_number AS VARCHAR), '_dbt_utils_surrogate_key_null_')))""")
def f4_fixed(spark, sf):
    """Trap 1: the policy fact's advisor key resolved from the risk master."""
    from ..operators import dims as D
    w = wh(spark, sf)
    return facts.fct_policies(
        w.dim_policy, w.fct_commissions, w.stg_valuations,
        facts.transactions_union(w.stg_risk_transactions, w.stg_investment_transactions),
        w.as_of, w.run_ts, fix_advisor=True, risk_advisors=D.latest_risk_advisors(w.stg_risk_policies))


# ------------------------------------------------------------------ marts
@register("m1_finance_advisor_commissions_monthly", "SELECT * FROM mart_finance")
def m1(spark, sf):
    return wh(spark, sf).finance_advisor_commissions_monthly


@register("m1_finance_advisor_commissions_monthly_fixed", """
SELECT m.* EXCLUDE (net_total_prior_year, pct_change_yoy), p.commission_net_total AS net_total_prior_year_exact,
  round(CASE WHEN p.commission_net_total IS NOT NULL AND p.commission_net_total <> 0
             THEN (m.commission_net_total - p.commission_net_total) / p.commission_net_total END, 6) AS pct_change_yoy
FROM mart_finance m LEFT JOIN mart_finance p
  ON m.company = p.company AND m.advisor_sk = p.advisor_sk AND m.commission_category = p.commission_category
 AND m.year_month = CAST(p.year_month + INTERVAL 12 MONTH AS DATE)""")
def m1_fixed(spark, sf):
    return marts.calendar_prior_year(wh(spark, sf).finance_advisor_commissions_monthly)


@register("m2_portfolio_aum_monthly", "SELECT * FROM mart_aum")
def m2(spark, sf):
    return wh(spark, sf).portfolio_aum_monthly


@register("m2_portfolio_aum_monthly_fixed", """
SELECT m.* REPLACE (p.aum_amount AS aum_prior_month,
    CAST(m.aum_amount - p.aum_amount AS DECIMAL(38,2)) AS aum_mom_change,
    round(CASE WHEN p.aum_amount IS NOT NULL AND p.aum_amount <> 0
               THEN (m.aum_amount - p.aum_amount) / p.aum_amount END, 6) AS aum_mom_pct_change,
    round(avg(m.aum_amount) OVER (PARTITION BY m.company, m.fund_sk ORDER BY m.year * 12 + m.month
                                  RANGE BETWEEN 11 PRECEDING AND CURRENT ROW), 6) AS aum_12m_avg)
FROM mart_aum m
LEFT JOIN mart_aum p ON m.company = p.company AND m.fund_sk = p.fund_sk
 AND m.year_month = CAST(p.year_month + INTERVAL 1 MONTH AS DATE)""")
def m2_fixed(spark, sf):
    return marts.calendar_aum_windows(wh(spark, sf).portfolio_aum_monthly)


@register("m3_risk_policy_inforce", "SELECT * FROM mart_risk")
def m3(spark, sf):
    return wh(spark, sf).risk_policy_inforce
