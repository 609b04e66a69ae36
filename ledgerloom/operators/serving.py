"""Serving queries (B1-B23): dashboard, semantic-model and BI-report
queries over the marts and facts.

Parameters become column predicates (no SQL string interpolation).  Every
top-k has a total tie-break so the result is deterministic.  Aggregates are
plain ``groupBy().agg()`` (partial aggregation before the shuffle); the few
"share of total" figures divide by an aggregate over a bounded, already
aggregated set (statuses, months, funds of one tenant).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from ..functions.safe import safe_ratio

BOTH = "BOTH"


def _money(c):
    return c.cast("decimal(38,2)")


def top_advisors_year(m1: DataFrame, year: int, n: int = 10) -> DataFrame:
    """B1: top-n (company, advisor) by net commission in a year."""
    return (m1.where(F.col("year") == year)
            .groupBy("company", "advisor_identifier")
            .agg(_money(F.sum("commission_net_total")).alias("total_net"))
            .orderBy(F.col("total_net").desc_nulls_last(), F.col("company").asc_nulls_last(),
                     F.col("advisor_identifier").asc_nulls_last())
            .limit(n))


def aum_trend_year(m2: DataFrame, company: str, year: int) -> DataFrame:
    """B2: monthly AUM of one tenant-year."""
    return (m2.where((F.col("company") == company) & (F.col("year") == year))
            .groupBy("year_month").agg(_money(F.sum("aum_amount")).alias("total_aum"))
            .orderBy("year_month"))


def lapse_rate_by_tenant(m3: DataFrame) -> DataFrame:
    """Ratio of sums per tenant."""
    return (m3.groupBy("company")
            .agg(F.round(safe_ratio(F.sum("lapsed_policy_count"), F.sum("policy_count")), 6)
                 .alias("lapse_rate")))


def _finance_filter(m1: DataFrame, company: str, category: str, year: int) -> DataFrame:
    cond = (F.col("company") == company) & (F.col("year") == year)
    if category != BOTH:
        cond = cond & (F.col("commission_category") == category)
    return m1.where(cond)


def finance_monthly_totals(m1: DataFrame, company: str, category: str, year: int) -> DataFrame:
    """Per-month totals for tenant x (category | BOTH) x year."""
    return (_finance_filter(m1, company, category, year)
            .groupBy(F.date_format("year_month", "yyyy-MM").alias("month"))
            .agg(_money(F.sum("commission_net_total")).alias("net_total"),
                 _money(F.sum("commission_gross_total")).alias("gross_total"),
                 F.sum("commission_count").alias("commission_count"))
            .orderBy("month"))


def finance_headline(m1: DataFrame, company: str, category: str, year: int) -> DataFrame:
    """Headline totals (one row)."""
    return (_finance_filter(m1, company, category, year)
            .agg(_money(F.sum("commission_net_total")).alias("net_total"),
                 _money(F.sum("commission_gross_total")).alias("gross_total"),
                 F.sum("commission_count").alias("commission_count")))


def finance_top_advisors(m1: DataFrame, company: str, category: str, year: int, n: int = 10) -> DataFrame:
    """Top-n advisors for tenant x category x year."""
    return (_finance_filter(m1, company, category, year)
            .groupBy("advisor_identifier")
            .agg(_money(F.sum("commission_net_total")).alias("net_total"),
                 F.sum("commission_count").alias("commission_count"))
            .orderBy(F.col("net_total").desc_nulls_last(), F.col("advisor_identifier").asc_nulls_last())
            .limit(n))


def _aum_filter(m2: DataFrame, company: str, fund_type: str) -> DataFrame:
    cond = F.col("company") == company
    if fund_type != BOTH:
        cond = cond & (F.col("fund_type") == fund_type)
    return m2.where(cond)


def aum_trend(m2: DataFrame, company: str, fund_type: str = BOTH) -> DataFrame:
    """AUM by month, optional fund type."""
    return (_aum_filter(m2, company, fund_type)
            .groupBy(F.date_format("year_month", "yyyy-MM").alias("month"))
            .agg(_money(F.sum("aum_amount")).alias("total_aum"))
            .orderBy("month"))


def aum_latest_point(m2: DataFrame, company: str, fund_type: str = BOTH) -> DataFrame:
    """B7 headline: the latest month and its AUM (one ``max_by`` aggregate
    over the monthly trend, no ordering of the whole series)."""
    trend = aum_trend(m2, company, fund_type)
    return trend.agg(F.max("month").alias("month"),
                     F.max_by("total_aum", "month").alias("total_aum"))


def top_funds_latest_month(m2: DataFrame, company: str, fund_type: str = BOTH, n: int = 15) -> DataFrame:
    """Top-n funds at the tenant's latest month.  The scalar subquery
    (latest month of the tenant, over all fund types) is a one-row aggregate
    joined on equality, so its broadcast is bounded by construction."""
    latest = (m2.where(F.col("company") == company)
              .agg(F.max("year_month").alias("year_month")))
    return (_aum_filter(m2, company, fund_type)
            .join(F.broadcast(latest), "year_month")
            .select("fund_name", "fund_type", "jse_code", "aum_amount", "aum_mom_pct_change")
            .orderBy(F.col("aum_amount").desc_nulls_last(), F.col("fund_name").asc_nulls_last())
            .limit(n))


def _risk_filter(m3: DataFrame, company: str) -> DataFrame:
    return m3 if company == "ALL" else m3.where(F.col("company") == company)


def risk_book_by_status(m3: DataFrame, company: str = "ALL") -> DataFrame:
    """Policies and annualised premium per status."""
    return (_risk_filter(m3, company)
            .groupBy("policy_status")
            .agg(F.sum("policy_count").alias("policies"),
                 _money(F.sum("annualised_premium")).alias("annualised_premium"))
            .orderBy(F.col("policies").desc(), F.col("policy_status")))


def risk_book_totals(m3: DataFrame, company: str = "ALL") -> DataFrame:
    """B9 headline: total, active, active share of book, annualised premium."""
    active = F.when(F.col("policy_status") == "Active", F.col("policy_count")).otherwise(0)
    return (_risk_filter(m3, company)
            .agg(F.sum("policy_count").alias("total_policies"),
                 F.sum(active).alias("active_policies"),
                 _money(F.sum("annualised_premium")).alias("annualised_premium"))
            .withColumn("active_share",
                        F.round(F.col("active_policies").cast("double")
                                / F.greatest(F.col("total_policies"), F.lit(1)).cast("double"), 6)))


def active_rate_breakdown(m3: DataFrame, company: str = "ALL", weighted: bool = False) -> DataFrame:
    """Smoker x bracket.  The dashboard averages the per-row 0/1 active
    rates (trap 7); ``weighted=True`` is the ratio of sums."""
    rate = (F.round(safe_ratio(F.sum("active_policy_count"), F.sum("policy_count")), 6) if weighted
            else F.round(F.avg("active_rate"), 6))
    return (_risk_filter(m3, company)
            .groupBy("smoker_status", "income_bracket")
            .agg(F.sum("policy_count").alias("policies"), rate.alias("avg_active_rate"))
            .orderBy("smoker_status", "income_bracket"))


def playground_default(m2: DataFrame, company: str = "MAIN_BOOK", n: int = 50) -> DataFrame:
    """The SQL playground's default listing."""
    return (m2.where(F.col("company") == company)
            .select("company", "fund_name", "year_month", "aum_amount")
            .orderBy(F.col("year_month").desc(), F.col("aum_amount").desc_nulls_last(),
                     F.col("fund_name").asc_nulls_last())
            .limit(n))


# --- fixed values: plan nodes of queries; every other node (writes, DDL,
# settings, scripts) is refused
QUERY_NODES = {
    "Project", "Filter", "Aggregate", "Join", "LateralJoin", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Distinct",
    "Union", "Intersect", "Except", "SubqueryAlias", "UnresolvedSubqueryColumnAliases", "UnresolvedRelation",
    "UnresolvedWith", "UnresolvedHaving", "UnresolvedInlineTable", "UnresolvedTableValuedFunction", "LocalRelation",
    "OneRowRelation", "WithWindowDefinition", "Window", "Generate", "Pivot", "Unpivot", "Sample", "UnresolvedHint",
}


def _plan_nodes(plan) -> list:
    """A parsed plan's nodes with those of its common table expressions."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        out.append(node)
        for inner in (node.children(), node.innerChildren()):
            for i in range(inner.size()):
                if hasattr(inner.apply(i), "innerChildren"):
                    todo.append(inner.apply(i))
    return out


def adhoc_sql(spark: SparkSession, views: dict[str, DataFrame], sql: str) -> DataFrame:
    """Read-only SQL over mart views.  The statement is parsed, and only
    a plan of query nodes is accepted.  The views exist while the statement
    is analysed; session views of the same names come back afterwards."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql.strip().rstrip(";"))
    except ParseException as e:
        raise ValueError("only a single read-only SELECT statement is allowed") from e
    kinds = {node.getClass().getSimpleName() for node in _plan_nodes(plan)}
    if kinds - QUERY_NODES:
        raise ValueError(f"only a read-only SELECT statement is allowed, not {sorted(kinds - QUERY_NODES)}")
    before = {name: spark.table(name) for name in views if spark.catalog.tableExists(name)}
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return spark.sql(sql.strip().rstrip(";"))
    finally:
        for name in views:
            spark.catalog.dropTempView(name)
            if name in before:
                before[name].createOrReplaceTempView(name)


# ------------------------------------------------------------------ BI measures
def total_net_commission(m1: DataFrame) -> DataFrame:
    """B14 evaluated per tenant and year."""
    return m1.groupBy("company", "year").agg(_money(F.sum("commission_net_total")).alias("total_net_commission"))


def avg_commission_per_advisor(m1: DataFrame) -> DataFrame:
    """Total net / distinct advisors, per tenant and year."""
    return (m1.groupBy("company", "year")
            .agg(_money(F.sum("commission_net_total")).alias("total_net_commission"),
                 F.countDistinct("advisor_sk").alias("advisors"))
            .withColumn("avg_commission_per_advisor",
                        F.round(safe_ratio("total_net_commission", "advisors"), 6)))


def mom_commission_calendar(m1: DataFrame) -> DataFrame:
    """Month-on-month delta and pct with a calendar shift of one month
    (no prior month: delta = current, pct = NULL).  Every month from a
    tenant's first to its last has a row, so a fall to zero is reported."""
    paid = m1.groupBy("company", "year_month").agg(F.sum("commission_net_total").alias("net"))
    spine = paid.groupBy("company").agg(F.min("year_month").alias("a"), F.max("year_month").alias("b")).select(
        "company", F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("year_month"))
    monthly = spine.join(paid, ["company", "year_month"], "left").select(
        "company", "year_month", _money(F.coalesce("net", F.lit(0))).alias("total_net_commission"))
    prior = monthly.select("company", F.add_months("year_month", 1).alias("year_month"),
                           F.col("total_net_commission").alias("prior_month_net"))
    j = monthly.join(prior, ["company", "year_month"], "left")
    delta = (F.col("total_net_commission") - F.coalesce(F.col("prior_month_net"), F.lit(0))).cast("decimal(38,2)")
    return j.select("company", "year_month", "total_net_commission", "prior_month_net",
                    delta.alias("mom_delta"),
                    F.round(safe_ratio(delta, "prior_month_net"), 6).alias("mom_pct"))


def aum_client_measures(fct_valuations: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Total AUM, distinct clients and AUM per client, per tenant-month,
    at valuation grain (re-aimed at the columns that exist, trap 16)."""
    cal = F.broadcast(dim_date.select("date_sk", F.col("month_start").alias("year_month")))
    v = fct_valuations.join(cal, "date_sk")
    return (v.groupBy("company", "year_month")
            .agg(_money(F.sum("market_value_amount")).alias("total_aum"),
                 F.countDistinct("client_sk").alias("distinct_clients"))
            .withColumn("avg_aum_per_client", F.round(safe_ratio("total_aum", "distinct_clients"), 6)))


def inforce_measures(dim_policy: DataFrame) -> DataFrame:
    """Active policies (distinct) and in-force life cover, per tenant."""
    active = F.col("policy_status") == "Active"
    return (dim_policy.groupBy("company")
            .agg(F.countDistinct(F.when(active, F.col("policy_sk"))).alias("active_policies"),
                 _money(F.sum(F.when(active, F.col("life_sum_assured")))).alias("inforce_sum_assured")))


def commission_date_drill(fct_commissions: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Year > Quarter > Month roll-up of net commission, over monthly
    sums (the roll-up's copies are made of those, not of the facts)."""
    cal = F.broadcast(dim_date.select("date_sk", "year", "quarter", "month"))
    monthly = fct_commissions.join(cal, "date_sk").groupBy("company", "year", "quarter", "month").agg(
        F.sum("net_amount").alias("net"), F.count(F.lit(1)).alias("n"))
    return (monthly.rollup("company", "year", "quarter", "month")
            .agg(_money(F.sum("net")).alias("net_total"),
                 F.sum("n").alias("commission_count"),
                 F.grouping_id().cast("int").alias("grouping_level")))


def advisor_year_matrix(m1: DataFrame, years: list[int]) -> DataFrame:
    """Advisors x years of net commission, explicit pivot values."""
    p = (m1.groupBy("company", "advisor_identifier")
         .pivot("year", years).agg(_money(F.sum("commission_net_total"))))
    return p.select("company", "advisor_identifier", *[F.col(str(y)).alias(f"y{y}") for y in years])


def fund_share_top(m2: DataFrame, n: int = 20) -> DataFrame:
    """Per tenant, funds by total AUM with share of the tenant total;
    top-n per tenant (window over the already aggregated funds of a tenant)."""
    funds = m2.groupBy("company", "fund_name").agg(_money(F.sum("aum_amount")).alias("total_aum"))
    by_company = Window.partitionBy("company")
    ranked = Window.partitionBy("company").orderBy(F.col("total_aum").desc_nulls_last(),
                                                   F.col("fund_name").asc_nulls_last())
    return (funds
            .withColumn("share_of_total", F.round(safe_ratio("total_aum", F.sum("total_aum").over(by_company)), 6))
            .withColumn("fund_rank", F.row_number().over(ranked))
            .where(F.col("fund_rank") <= n))


def commission_statement(fct_commissions: DataFrame, month_start: str,
                         company: str | None = None, advisor: str | None = None) -> DataFrame:
    """Monthly commission statement by business line with an advisor
    subtotal, for every advisor of the month or one of them."""
    first = F.trunc(F.lit(month_start).cast("date"), "month")
    f = fct_commissions.where((F.col("transaction_date") >= first) & (F.col("transaction_date") < F.add_months(first, 1)))
    f = f.where(F.col("advisor_identifier").isNotNull())
    if company:
        f = f.where(F.col("company") == company)
    if advisor:
        f = f.where(F.col("advisor_identifier") == advisor)
    line = ["company", "advisor_identifier", "business_line"]
    g = (f.groupingSets([line, line[:2]], *line)
         .agg(_money(F.sum("gross_amount")).alias("gross_amount"),
              _money(F.sum("vat_amount")).alias("vat_amount"),
              _money(F.sum("net_amount")).alias("net_amount"),
              F.count(F.lit(1)).alias("commission_count"),
              F.grouping_id().cast("int").alias("gid")))
    return (g.select("company", "advisor_identifier", "business_line", "gross_amount", "vat_amount",
                     "net_amount", "commission_count", (F.col("gid") == 1).alias("is_subtotal")))


def advisor_parameter_list(dim_advisor: DataFrame) -> DataFrame:
    """Distinct advisors, ordered."""
    return dim_advisor.select("advisor_identifier").distinct().orderBy("advisor_identifier")
