"""Registered queries: serving (B*), semantic layer (B13) and governance (G*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..operators import governance as G
from ..operators import serving as B
from ..plans.semantic import SemanticModel
from .core import wh

YEAR = 2018
TENANT = "MAIN_BOOK"
STATEMENT_MONTH = "2018-03-01"
#: Every year of the calendar dimension.
PIVOT_YEARS = list(range(2015, 2031))


@register("b1_top_advisors_year", f"""
SELECT company, advisor_identifier, CAST(sum(commission_net_total) AS DECIMAL(38,2)) AS total_net
FROM mart_finance WHERE year = {YEAR} GROUP BY company, advisor_identifier
ORDER BY total_net DESC NULLS LAST, company ASC NULLS LAST, advisor_identifier ASC NULLS LAST LIMIT 10""")
def b1(spark, sf):
    return B.top_advisors_year(wh(spark, sf).finance_advisor_commissions_monthly, YEAR)


@register("b2_aum_trend_tenant_year", f"""
SELECT year_month, CAST(sum(aum_amount) AS DECIMAL(38,2)) AS total_aum FROM mart_aum
WHERE company = '{TENANT}' AND year = {YEAR} GROUP BY year_month ORDER BY year_month""")
def b2(spark, sf):
    return B.aum_trend_year(wh(spark, sf).portfolio_aum_monthly, TENANT, YEAR)


@register("b3_lapse_rate_by_tenant", """
SELECT company, round(sum(lapsed_policy_count) * 1.0 / nullif(sum(policy_count), 0), 6) AS lapse_rate
FROM mart_risk GROUP BY company""")
def b3(spark, sf):
    return B.lapse_rate_by_tenant(wh(spark, sf).risk_policy_inforce)


_FIN_WHERE = f"company = '{TENANT}' AND year = {YEAR}"


@register("b4_finance_monthly_totals", f"""
SELECT strftime(year_month, '%Y-%m') AS month, CAST(sum(commission_net_total) AS DECIMAL(38,2)) AS net_total,
  CAST(sum(commission_gross_total) AS DECIMAL(38,2)) AS gross_total, sum(commission_count) AS commission_count
FROM mart_finance WHERE {_FIN_WHERE} GROUP BY 1 ORDER BY 1""")
def b4(spark, sf):
    return B.finance_monthly_totals(wh(spark, sf).finance_advisor_commissions_monthly, TENANT, B.BOTH, YEAR)


@register("b4_finance_monthly_totals_insurance", f"""
SELECT strftime(year_month, '%Y-%m') AS month, CAST(sum(commission_net_total) AS DECIMAL(38,2)) AS net_total,
  CAST(sum(commission_gross_total) AS DECIMAL(38,2)) AS gross_total, sum(commission_count) AS commission_count
FROM mart_finance WHERE {_FIN_WHERE} AND commission_category = 'INSURANCE' GROUP BY 1 ORDER BY 1""")
def b4_ins(spark, sf):
    return B.finance_monthly_totals(wh(spark, sf).finance_advisor_commissions_monthly, TENANT, "INSURANCE", YEAR)


@register("b5_finance_headline", f"""
SELECT CAST(sum(commission_net_total) AS DECIMAL(38,2)) AS net_total,
  CAST(sum(commission_gross_total) AS DECIMAL(38,2)) AS gross_total, sum(commission_count) AS commission_count
FROM mart_finance WHERE {_FIN_WHERE}""")
def b5(spark, sf):
    return B.finance_headline(wh(spark, sf).finance_advisor_commissions_monthly, TENANT, B.BOTH, YEAR)


@register("b6_finance_top_advisors", f"""
SELECT advisor_identifier, CAST(sum(commission_net_total) AS DECIMAL(38,2)) AS net_total,
  sum(commission_count) AS commission_count
FROM mart_finance WHERE {_FIN_WHERE} AND commission_category = 'INVESTMENT' GROUP BY advisor_identifier
ORDER BY net_total DESC NULLS LAST, advisor_identifier ASC NULLS LAST LIMIT 10""")
def b6(spark, sf):
    return B.finance_top_advisors(wh(spark, sf).finance_advisor_commissions_monthly, TENANT, "INVESTMENT", YEAR)


@register("b7_aum_trend", f"""
SELECT strftime(year_month, '%Y-%m') AS month, CAST(sum(aum_amount) AS DECIMAL(38,2)) AS total_aum
FROM mart_aum WHERE company = '{TENANT}' GROUP BY 1 ORDER BY 1""")
def b7(spark, sf):
    return B.aum_trend(wh(spark, sf).portfolio_aum_monthly, TENANT)


@register("b7_aum_trend_etf", f"""
SELECT strftime(year_month, '%Y-%m') AS month, CAST(sum(aum_amount) AS DECIMAL(38,2)) AS total_aum
FROM mart_aum WHERE company = '{TENANT}' AND fund_type = 'ETF' GROUP BY 1 ORDER BY 1""")
def b7_etf(spark, sf):
    return B.aum_trend(wh(spark, sf).portfolio_aum_monthly, TENANT, "ETF")


@register("b7_aum_latest_point", f"""
SELECT max(month) AS month, arg_max(total_aum, month) AS total_aum FROM (
  SELECT strftime(year_month, '%Y-%m') AS month, CAST(sum(aum_amount) AS DECIMAL(38,2)) AS total_aum
  FROM mart_aum WHERE company = '{TENANT}' GROUP BY 1)""")
def b7_latest(spark, sf):
    return B.aum_latest_point(wh(spark, sf).portfolio_aum_monthly, TENANT)


@register("b8_top_funds_latest_month", f"""
SELECT fund_name, fund_type, jse_code, aum_amount, aum_mom_pct_change FROM mart_aum
WHERE company = '{TENANT}' AND year_month = (SELECT max(year_month) FROM mart_aum WHERE company = '{TENANT}')
ORDER BY aum_amount DESC NULLS LAST, fund_name ASC NULLS LAST LIMIT 15""")
def b8(spark, sf):
    return B.top_funds_latest_month(wh(spark, sf).portfolio_aum_monthly, TENANT)


@register("b9_risk_book_by_status", """
SELECT policy_status, sum(policy_count) AS policies, CAST(sum(annualised_premium) AS DECIMAL(38,2)) AS annualised_premium
FROM mart_risk GROUP BY policy_status ORDER BY policies DESC, policy_status""")
def b9(spark, sf):
    return B.risk_book_by_status(wh(spark, sf).risk_policy_inforce)


@register("b9_risk_book_totals", f"""
SELECT sum(policy_count) AS total_policies,
  sum(CASE WHEN policy_status = 'Active' THEN policy_count ELSE 0 END) AS active_policies,
  CAST(sum(annualised_premium) AS DECIMAL(38,2)) AS annualised_premium,
  round(CAST(sum(CASE WHEN policy_status = 'Active' THEN policy_count ELSE 0 END) AS DOUBLE)
        / greatest(sum(policy_count), 1), 6) AS active_share
FROM mart_risk WHERE company = '{TENANT}'""")
def b9_totals(spark, sf):
    return B.risk_book_totals(wh(spark, sf).risk_policy_inforce, TENANT)


@register("b10_active_rate_breakdown", """
SELECT smoker_status, income_bracket, sum(policy_count) AS policies, round(avg(active_rate), 6) AS avg_active_rate
FROM mart_risk GROUP BY smoker_status, income_bracket ORDER BY smoker_status, income_bracket""")
def b10(spark, sf):
    return B.active_rate_breakdown(wh(spark, sf).risk_policy_inforce)


@register("b10_active_rate_breakdown_fixed", """
SELECT smoker_status, income_bracket, sum(policy_count) AS policies,
  round(CAST(sum(active_policy_count) AS DOUBLE) / nullif(sum(policy_count), 0), 6) AS avg_active_rate
FROM mart_risk GROUP BY smoker_status, income_bracket ORDER BY smoker_status, income_bracket""")
def b10_fixed(spark, sf):
    return B.active_rate_breakdown(wh(spark, sf).risk_policy_inforce, weighted=True)


_B11_SQL = f"""
SELECT company, fund_name, year_month, aum_amount FROM mart_aum WHERE company = '{TENANT}'
ORDER BY year_month DESC, aum_amount DESC NULLS LAST, fund_name ASC NULLS LAST LIMIT 50"""


@register("b11_playground_default", _B11_SQL)
def b11(spark, sf):
    return B.playground_default(wh(spark, sf).portfolio_aum_monthly, TENANT)


PLAYGROUND_SQL = """
select company, fund_name, year_month, aum_amount
from portfolio_aum_monthly
where company = 'MAIN_BOOK'
order by year_month desc, aum_amount desc nulls last, fund_name asc nulls last
limit 50;"""


@register("b12_adhoc_sql_over_marts", _B11_SQL)
def b12(spark, sf):
    w = wh(spark, sf)
    return B.adhoc_sql(spark, {"portfolio_aum_monthly": w.portfolio_aum_monthly}, PLAYGROUND_SQL)


def semantic(w) -> SemanticModel:
    return SemanticModel({"advisor_commissions_monthly": w.finance_advisor_commissions_monthly,
                          "aum_monthly": w.portfolio_aum_monthly,
                          "policy_inforce": w.risk_policy_inforce})


@register("b13_semantic_net_by_tenant_category", """
SELECT company, commission_category, CAST(sum(commission_net_total) AS DECIMAL(38,2)) AS commission_net_total,
  CAST(sum(commission_count) AS BIGINT) AS commission_count,
  round(avg(avg_commission_amount), 6) AS avg_commission_amount
FROM mart_finance GROUP BY company, commission_category""")
def b13(spark, sf):
    return semantic(wh(spark, sf)).query(
        "commissions", ["net commissions", "deal count", "average deal size"], ["tenant", "category"])


@register("b13_semantic_aum_by_fund_type", """
SELECT company, fund_type, CAST(sum(aum_amount) AS DECIMAL(38,2)) AS aum_amount,
  CAST(sum(unique_clients) AS BIGINT) AS unique_clients
FROM mart_aum GROUP BY company, fund_type""")
def b13_aum(spark, sf):
    return semantic(wh(spark, sf)).query("portfolio", ["AUM", "number of clients"],
                                         ["tenant", "product structure"])


@register("b13_unique_clients_fixed", """
SELECT v.company, f.fund_type, count(DISTINCT v.client_sk) AS unique_clients
FROM fct_valuations v JOIN dim_date d ON v.date_sk = d.date_sk JOIN dim_fund f ON v.fund_sk = f.fund_sk
WHERE v.market_value_amount IS NOT NULL GROUP BY v.company, f.fund_type""")
def b13_fixed(spark, sf):
    """Distinct clients per tenant x fund type recomputed at valuation grain
    (summing the mart's per-month distinct counts double-counts, trap 17)."""
    w = wh(spark, sf)
    cal = F.broadcast(w.dim_date.select("date_sk"))
    v = w.valuations_keyed.where(F.col("market_value_amount").isNotNull()).join(cal, "date_sk")
    return (v.join(w.dim_fund.select("fund_sk", "fund_type"), "fund_sk")
            .groupBy("company", "fund_type").agg(F.countDistinct("client_sk").alias("unique_clients")))


_VALUED = """
FROM fct_valuations v JOIN dim_date d ON v.date_sk = d.date_sk JOIN dim_fund f ON v.fund_sk = f.fund_sk
WHERE v.market_value_amount IS NOT NULL"""


def _client_sets(w):
    """Clients per company, fund type, fund and month as bitmaps."""
    from ..operators.distincts import distinct_sets
    days = F.broadcast(w.dim_date.select("date_sk", F.trunc("date_day", "month").alias("year_month")))   # a row a day
    v = w.valuations_keyed.where(F.col("market_value_amount").isNotNull()).join(days, "date_sk")
    v = v.join(w.dim_fund.select("fund_sk", "fund_type"), "fund_sk")
    return distinct_sets(v, "client_sk", ["company", "fund_type", "fund_sk", "year_month"])


@register("b13_unique_clients_merged", f"""
SELECT v.company, f.fund_type, count(DISTINCT v.client_sk) AS unique_clients {_VALUED}
GROUP BY v.company, f.fund_type HAVING count(DISTINCT v.client_sk) > 0""")
def b13_merged(spark, sf):
    """Distinct clients per tenant and fund type, from the mart's bitmaps per fund and month."""
    from ..operators.distincts import distinct_counts
    return distinct_counts(_client_sets(wh(spark, sf)), ["company", "fund_type"], "unique_clients")


@register("m2_unique_clients_yearly", f"""
SELECT v.company, v.fund_sk, d.year, count(DISTINCT v.client_sk) AS unique_clients {_VALUED}
GROUP BY v.company, v.fund_sk, d.year HAVING count(DISTINCT v.client_sk) > 0""")
def m2_yearly(spark, sf):
    """Distinct clients per fund and year: the same bitmaps, merged over months."""
    from ..operators.distincts import distinct_counts
    sets = _client_sets(wh(spark, sf)).withColumn("year", F.year("year_month"))
    return distinct_counts(sets, ["company", "fund_sk", "year"], "unique_clients")


@register("b13_semantic_closing_aum", """
SELECT company, fund_type, CAST(sum(aum_amount) FILTER (WHERE year_month = top) AS DECIMAL(38,2)) AS closing_aum,
  CAST(sum(unique_policies) FILTER (WHERE year_month = top) AS BIGINT) AS closing_policies,
  round(CASE WHEN sum(unique_policies) <> 0 THEN CAST(sum(aum_amount) AS DOUBLE) / sum(unique_policies) END, 6) AS aum_per_policy
FROM (SELECT *, max(year_month) OVER (PARTITION BY company, fund_type) AS top FROM mart_aum) GROUP BY company, fund_type""")
def b13_closing(spark, sf):
    """Balances of each group's last month beside a ratio of sums."""
    return semantic(wh(spark, sf)).query("portfolio", ["closing_aum", "closing_policies", "aum_per_policy"],
                                         ["tenant", "product structure"])


@register("b13_semantic_rates", """
SELECT company, round(sum(lapsed_policy_count) * 1.0 / nullif(sum(policy_count), 0), 6) AS lapse_rate,
  round(sum(active_policy_count) * 1.0 / nullif(sum(policy_count), 0), 6) AS active_rate,
  CAST(sum(policy_count) AS BIGINT) AS policy_count
FROM mart_risk GROUP BY company""")
def b13_rates(spark, sf):
    """Rates as ratios of sums (B3 through the semantic layer)."""
    return semantic(wh(spark, sf)).query("policy book", ["attrition rate", "active_rate", "book size"], ["tenant"])


@register("b14_total_net_commission", """
SELECT company, year, CAST(sum(commission_net_total) AS DECIMAL(38,2)) AS total_net_commission
FROM mart_finance GROUP BY company, year""")
def b14(spark, sf):
    return B.total_net_commission(wh(spark, sf).finance_advisor_commissions_monthly)


@register("b15_avg_commission_per_advisor", """
SELECT company, year, total_net_commission, advisors,
  round(CASE WHEN advisors <> 0 THEN CAST(total_net_commission AS DOUBLE) / advisors END, 6) AS avg_commission_per_advisor
FROM (SELECT company, year, CAST(sum(commission_net_total) AS DECIMAL(38,2)) AS total_net_commission,
        count(DISTINCT advisor_sk) AS advisors FROM mart_finance GROUP BY company, year)""")
def b15(spark, sf):
    return B.avg_commission_per_advisor(wh(spark, sf).finance_advisor_commissions_monthly)


@register("b16_mom_commission_calendar", """
SELECT * FROM (WITH months AS (
  SELECT s.company, s.year_month, CAST(coalesce(x.net, 0) AS DECIMAL(38,2)) AS total_net_commission
  FROM (SELECT company, CAST(unnest(generate_series(min(year_month), max(year_month), INTERVAL 1 MONTH)) AS DATE) AS year_month
        FROM mart_finance GROUP BY company) s
  LEFT JOIN (SELECT company, year_month, sum(commission_net_total) AS net FROM mart_finance GROUP BY company, year_month) x
    ON s.company = x.company AND s.year_month = x.year_month)
SELECT m.company, m.year_month, m.total_net_commission, p.total_net_commission AS prior_month_net,
  CAST(m.total_net_commission - coalesce(p.total_net_commission, 0) AS DECIMAL(38,2)) AS mom_delta,
  round(CASE WHEN p.total_net_commission IS NOT NULL AND p.total_net_commission <> 0
        THEN CAST(m.total_net_commission - coalesce(p.total_net_commission, 0) AS DOUBLE)
             / CAST(p.total_net_commission AS DOUBLE) END, 6) AS mom_pct
FROM months m LEFT JOIN months p
  ON m.company = p.company AND m.year_month = CAST(p.year_month + INTERVAL 1 MONTH AS DATE))""")
def b16(spark, sf):
    return B.mom_commission_calendar(wh(spark, sf).finance_advisor_commissions_monthly)


@register("b17_aum_client_measures", """
SELECT company, year_month, total_aum, distinct_clients,
  round(CASE WHEN distinct_clients <> 0 THEN CAST(total_aum AS DOUBLE) / distinct_clients END, 6) AS avg_aum_per_client
FROM (SELECT v.company, d.month_start AS year_month, CAST(sum(v.market_value_amount) AS DECIMAL(38,2)) AS total_aum,
        count(DISTINCT v.client_sk) AS distinct_clients
      FROM fct_valuations v JOIN dim_date d ON v.date_sk = d.date_sk GROUP BY 1, 2)""")
def b17(spark, sf):
    w = wh(spark, sf)
    return B.aum_client_measures(w.valuations_keyed, w.dim_date)


@register("b18_inforce_measures", """
SELECT company, count(DISTINCT CASE WHEN policy_status = 'Active' THEN policy_sk END) AS active_policies,
  CAST(sum(CASE WHEN policy_status = 'Active' THEN life_sum_assured END) AS DECIMAL(38,2)) AS inforce_sum_assured
FROM dim_policy GROUP BY company""")
def b18(spark, sf):
    return B.inforce_measures(wh(spark, sf).dim_policy)


@register("b19_commission_date_drill", """
SELECT c.company, d.year, d.quarter, d.month, CAST(sum(c.net_amount) AS DECIMAL(38,2)) AS net_total,
  count(*) AS commission_count, CAST(grouping(c.company, d.year, d.quarter, d.month) AS INTEGER) AS grouping_level
FROM fct_commissions c JOIN dim_date d ON c.date_sk = d.date_sk
GROUP BY ROLLUP (c.company, d.year, d.quarter, d.month)""")
def b19(spark, sf):
    w = wh(spark, sf)
    return B.commission_date_drill(w.fct_commissions, w.dim_date)


_PIVOT_COLS = ", ".join(f"CAST(sum(commission_net_total) FILTER (WHERE year = {y}) AS DECIMAL(38,2)) AS y{y}"
                        for y in PIVOT_YEARS)


@register("b20_advisor_year_matrix", f"""
SELECT company, advisor_identifier, {_PIVOT_COLS} FROM mart_finance GROUP BY company, advisor_identifier""")
def b20(spark, sf):
    return B.advisor_year_matrix(wh(spark, sf).finance_advisor_commissions_monthly, PIVOT_YEARS)


@register("b21_fund_share_top", """
SELECT * FROM (
  SELECT company, fund_name, total_aum,
    round(CAST(total_aum AS DOUBLE) / nullif(CAST(sum(total_aum) OVER (PARTITION BY company) AS DOUBLE), 0), 6) AS share_of_total,
    CAST(row_number() OVER (PARTITION BY company ORDER BY total_aum DESC NULLS LAST, fund_name ASC NULLS LAST) AS INTEGER) AS fund_rank
  FROM (SELECT company, fund_name, CAST(sum(aum_amount) AS DECIMAL(38,2)) AS total_aum
        FROM mart_aum GROUP BY company, fund_name))
WHERE fund_rank <= 20""")
def b21(spark, sf):
    return B.fund_share_top(wh(spark, sf).portfolio_aum_monthly)


@register("b22_commission_statement", f"""
SELECT company, advisor_identifier, business_line, gross_amount, vat_amount, net_amount, commission_count,
  gid = 1 AS is_subtotal
FROM (SELECT company, advisor_identifier, business_line,
        CAST(sum(gross_amount) AS DECIMAL(38,2)) AS gross_amount, CAST(sum(vat_amount) AS DECIMAL(38,2)) AS vat_amount,
        CAST(sum(net_amount) AS DECIMAL(38,2)) AS net_amount, count(*) AS commission_count,
        grouping(company, advisor_identifier, business_line) AS gid
      FROM fct_commissions
      WHERE date_trunc('month', transaction_date) = DATE '{STATEMENT_MONTH}' AND advisor_identifier IS NOT NULL
      GROUP BY ROLLUP (company, advisor_identifier, business_line))
WHERE gid IN (0, 1)""")
def b22(spark, sf):
    return B.commission_statement(wh(spark, sf).fct_commissions, STATEMENT_MONTH)


@register("b23_advisor_parameter_list", """
SELECT DISTINCT advisor_identifier FROM dim_advisor ORDER BY 1""")
def b23(spark, sf):
    return B.advisor_parameter_list(wh(spark, sf).dim_advisor)


# ------------------------------------------------------------------ governance
_MASKED = """
SELECT client_sk, company, '***MASKED***' AS client_id_number, client_title, '***MASKED***' AS client_first_name,
  '***MASKED***' AS client_surname, client_initials, '***MASKED***' AS client_full_name,
  CAST(date_trunc('year', birth_date) AS DATE) AS birth_date, age_years, _loaded_at
FROM dim_client"""


@register("g1_g2_g3_dim_client_masked", _MASKED)
def g3_masked(spark, sf):
    return G.masked_view(wh(spark, sf).dim_client, role="FR_ANALYST")


@register("g3_dim_client_privileged", "SELECT * FROM dim_client")
def g3_priv(spark, sf):
    return G.masked_view(wh(spark, sf).dim_client, role="FR_ENGINEER")


@register("g3_masked_lineage", """
SELECT company, count(*) AS clients, count(birth_date) AS with_birth_date,
  CAST(date_trunc('year', min(birth_date)) AS DATE) AS eldest, CAST(NULL AS INTEGER) AS latest_birth_year,
  '***MASKED***' AS first_surname
FROM dim_client GROUP BY company""")
def g3_lineage(spark, sf):
    """A view over the clients whose derived columns are masked without being
    listed: its columns have names that no column policy knows."""
    view = wh(spark, sf).dim_client.groupBy("company").agg(
        F.count(F.lit(1)).alias("clients"), F.count("birth_date").alias("with_birth_date"),
        F.min("birth_date").alias("eldest"), F.max(F.year("birth_date")).alias("latest_birth_year"),
        F.min("client_surname").alias("first_surname"))
    return G.masked_lineage(view, role="FR_ANALYST")


@register("g4_tenant_row_filter", """
SELECT * FROM mart_finance WHERE company IN ('MAIN_BOOK', 'HORIZON_ASSURANCE')""")
def g4(spark, sf):
    return G.tenant_filter(wh(spark, sf).finance_advisor_commissions_monthly, ["MAIN_BOOK", "HORIZON_ASSURANCE"])
