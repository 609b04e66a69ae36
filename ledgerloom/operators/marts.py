"""Marts (M1-M3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.safe import pct_change


def _calendar(dim_date: DataFrame) -> DataFrame:
    # Broadcast is safe: dim_date is one row per day of a checked range.
    return F.broadcast(dim_date.select("date_sk", "year", "month", F.col("month_start").alias("year_month")))


def finance_advisor_commissions_monthly(fct_commissions: DataFrame, dim_date: DataFrame,
                                        run_ts) -> DataFrame:
    """M1: advisor x month x category commission totals, running total and
    prior-year (same calendar month, previous *available* year: trap 3).

    The advisor dimension lookup is folded into the aggregation: the
    dimension holds exactly the non-NULL (company, advisor_identifier) pairs
    hashed into ``advisor_sk``, so the identifier is carried through the
    group-by instead of joining.  Both windows partition by a superset of
    (company, advisor_sk, category), so they share one exchange of the
    (small) aggregated rows."""
    c = fct_commissions.where(F.col("advisor_sk").isNotNull()).join(_calendar(dim_date), "date_sk")
    # advisor_identifier is functionally determined by (company, advisor_sk):
    # grouping on it keeps the aggregate a HashAggregate (a string max()
    # would force a sort-based aggregate).
    agg = c.groupBy("company", "advisor_sk", "advisor_identifier", "year_month", "year", "month",
                    "commission_category").agg(
        F.count(F.lit(1)).alias("commission_count"),
        F.sum("gross_amount").cast("decimal(38,2)").alias("commission_gross_total"),
        F.sum("net_amount").cast("decimal(38,2)").alias("commission_net_total"),
        F.round(F.avg("net_amount").cast("double"), 6).alias("avg_commission_amount"))
    keys = ["company", "advisor_sk", "commission_category"]
    running = Window.partitionBy(*keys).orderBy("year_month").rowsBetween(Window.unboundedPreceding, 0)
    prior = Window.partitionBy(*keys, "month").orderBy("year")
    enriched = (agg.repartition(*keys)
                .withColumn("running_net_total", F.sum("commission_net_total").over(running).cast("decimal(38,2)"))
                .withColumn("net_total_prior_year", F.lag("commission_net_total").over(prior)))
    return enriched.select(
        surrogate_key("company", "advisor_sk", "year_month", "commission_category").alias("mart_key"),
        "company", "advisor_sk", "advisor_identifier", "year_month", "year", "month",
        "commission_category", "commission_count", "commission_gross_total", "commission_net_total",
        "avg_commission_amount", "running_net_total", "net_total_prior_year",
        F.round(pct_change("commission_net_total", "net_total_prior_year"), 6).alias("pct_change_yoy"),
        F.lit(run_ts).alias("_loaded_at"))


def calendar_prior_year(m1: DataFrame) -> DataFrame:
    """M1 corrected (trap 3): prior year is the same month exactly one
    calendar year earlier, found by an equi-join on the shifted month."""
    prev = m1.select("company", "advisor_sk", "commission_category",
                     F.add_months("year_month", 12).alias("year_month"),
                     F.col("commission_net_total").alias("net_total_prior_year_exact"))
    out = m1.drop("net_total_prior_year", "pct_change_yoy").join(
        prev, ["company", "advisor_sk", "commission_category", "year_month"], "left")
    return out.withColumn("pct_change_yoy",
                          F.round(pct_change("commission_net_total", "net_total_prior_year_exact"), 6))


def portfolio_aum_monthly(fct_valuations: DataFrame, dim_date: DataFrame, dim_fund: DataFrame,
                          run_ts) -> DataFrame:
    """M2: fund x month AUM from the latest valuation per
    (company, policy, fund, month).

    The latest-per-month pick is a ``max_by`` aggregate: partial aggregation
    pre-combines each key before the shuffle (a hot policy-fund-month is
    reduced map-side); the tie-break after ``valuation_date desc`` is total
    (trap 8).
    Distinct policy and client counts are exact.  The fund dimension join is
    left to AQE (it broadcasts at runtime when the fund list is small)."""
    v = (fct_valuations.where(F.col("fund_sk").isNotNull() & F.col("market_value_amount").isNotNull())
         .join(_calendar(dim_date), "date_sk"))
    # the rank ends with the whole payload: equal ranks carry equal payloads
    rank = F.struct(F.col("valuation_date"), F.col("market_value_amount"), F.col("units"),
                    F.col("client_sk"))
    latest = (v.groupBy("company", "policy_sk", "fund_sk", "year", "month", "year_month")
              .agg(F.max_by(F.struct("market_value_amount", "units", "client_sk"), rank).alias("l"))
              .select("company", "policy_sk", "fund_sk", "year", "month", "year_month", "l.*"))
    agg = latest.groupBy("company", "fund_sk", "year_month", "year", "month").agg(
        F.sum("market_value_amount").cast("decimal(38,2)").alias("aum_amount"),
        F.sum("units").cast("decimal(38,4)").alias("total_units"),
        F.countDistinct("policy_sk").alias("unique_policies"),
        F.countDistinct("client_sk").alias("unique_clients"))
    funds = dim_fund.select("fund_sk", "fund_name", "fund_type", "jse_code")
    w = Window.partitionBy("company", "fund_sk").orderBy("year_month")
    enriched = (agg.join(funds, "fund_sk", "left")
                .withColumn("aum_prior_month", F.lag("aum_amount").over(w))
                .withColumn("aum_12m_avg", F.round(F.avg("aum_amount").over(w.rowsBetween(-11, 0)).cast("double"), 6)))
    return enriched.select(
        surrogate_key("company", "fund_sk", "year_month").alias("mart_key"),
        "company", "fund_sk", "fund_name", "fund_type", "jse_code", "year_month", "year", "month",
        "aum_amount", "total_units", "unique_policies", "unique_clients", "aum_prior_month",
        (F.col("aum_amount") - F.col("aum_prior_month")).cast("decimal(38,2)").alias("aum_mom_change"),
        F.round(pct_change("aum_amount", "aum_prior_month"), 6).alias("aum_mom_pct_change"),
        "aum_12m_avg",
        F.lit(run_ts).alias("_loaded_at"))


def calendar_aum_windows(m2: DataFrame) -> DataFrame:
    """M2 corrected (trap 4): the prior month is exactly one calendar month
    earlier (equi-join on the shifted month, NULL when that month has no
    row), and the trailing average covers the last 12 *calendar* months
    (a range frame over a month index; months without a row are absent, not
    zero)."""
    prev = m2.select("company", "fund_sk", F.add_months("year_month", 1).alias("year_month"),
                     F.col("aum_amount").alias("aum_prior_month"))
    base = m2.drop("aum_prior_month", "aum_mom_change", "aum_mom_pct_change", "aum_12m_avg")
    idx = (F.col("year") * 12 + F.col("month")).cast("int")
    w = Window.partitionBy("company", "fund_sk").orderBy(idx).rangeBetween(-11, 0)
    return (base.join(prev, ["company", "fund_sk", "year_month"], "left")
            .withColumn("aum_mom_change", (F.col("aum_amount") - F.col("aum_prior_month")).cast("decimal(38,2)"))
            .withColumn("aum_mom_pct_change", F.round(pct_change("aum_amount", "aum_prior_month"), 6))
            .withColumn("aum_12m_avg", F.round(F.avg("aum_amount").over(w).cast("double"), 6)))


def risk_policy_inforce(dim_policy: DataFrame, run_ts) -> DataFrame:
    """M3: RISK policies by company x status x smoker x bracket (NULL ->
    'UNKNOWN'); conditional counts are ``count_if``, rates are guarded."""
    p = dim_policy.where(F.col("policy_universe") == "RISK")
    status = F.col("policy_status")
    agg = p.groupBy(
        "company",
        F.coalesce(status, F.lit("UNKNOWN")).alias("policy_status_g"),
        F.coalesce(F.col("smoker_status"), F.lit("UNKNOWN")).alias("smoker_status"),
        F.coalesce(F.col("income_bracket"), F.lit("UNKNOWN")).alias("income_bracket"),
    ).agg(
        F.count(F.lit(1)).alias("policy_count"),
        F.count_if(status == "Active").alias("active_policy_count"),
        F.count_if(status == "Lapsed").alias("lapsed_policy_count"),
        F.count_if(status == "Cancelled").alias("cancelled_policy_count"),
        F.count_if(status == "Pending").alias("pending_policy_count"),
        F.sum("total_monthly_premium").cast("decimal(38,2)").alias("total_monthly_premium_sum"),
        F.round(F.avg("total_monthly_premium").cast("double"), 6).alias("avg_monthly_premium"),
        (F.sum("total_monthly_premium") * 12).cast("decimal(38,2)").alias("annualised_premium"),
        F.round(F.avg("age_next").cast("double"), 6).alias("avg_age_next"),
        F.sum("life_sum_assured").cast("decimal(38,2)").alias("total_life_sum_assured"),
        F.round(F.avg("life_sum_assured").cast("double"), 6).alias("avg_life_sum_assured"),
        F.sum("disability_sum_assured").cast("decimal(38,2)").alias("total_disability_sum_assured"),
    ).withColumnRenamed("policy_status_g", "policy_status")
    rate = lambda n: F.round(F.when(F.col("policy_count") != 0,
                                    F.col(n).cast("double") / F.col("policy_count").cast("double")), 6)
    return agg.select(
        surrogate_key("company", "policy_status", "smoker_status", "income_bracket").alias("mart_key"),
        "company", "policy_status", "smoker_status", "income_bracket", "policy_count",
        "active_policy_count", "lapsed_policy_count", "cancelled_policy_count", "pending_policy_count",
        rate("active_policy_count").alias("active_rate"), rate("lapsed_policy_count").alias("lapse_rate"),
        "total_monthly_premium_sum", "avg_monthly_premium", "annualised_premium", "avg_age_next",
        "total_life_sum_assured", "avg_life_sum_assured", "total_disability_sum_assured",
        F.lit(run_ts).alias("_loaded_at"))
