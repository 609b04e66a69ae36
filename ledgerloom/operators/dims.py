"""Conformed dimensions.

Every dimension is keyed by a hash of its natural key (K1), so facts compute
their foreign keys by hashing instead of joining (the reference does the
same).  Unions of tenants are free: staging frames already hold all tenants.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import year_boundaries
from ..functions.keys import date_key, surrogate_key

# --- fixed values: calendar range of the date dimension --------------------
DATE_SPINE_START = "2015-01-01"
DATE_SPINE_END_EXCLUSIVE = "2031-01-01"
FISCAL_YEAR_START_MONTH = 3
# Bound used to justify broadcasting the calendar: one row per day.
MAX_CALENDAR_DAYS = 366 * 200


def _union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def dim_date(spark: SparkSession, start: str = DATE_SPINE_START,
             end_exclusive: str = DATE_SPINE_END_EXCLUSIVE) -> DataFrame:
    """D3: one row per day in [start, end_exclusive).

    Built from ``spark.range`` (distributed, no giant array in one row).  Its
    size is a function of the range only, so broadcasting it is safe; the
    range is checked against ``MAX_CALENDAR_DAYS``."""
    n_days = (dt.date.fromisoformat(end_exclusive) - dt.date.fromisoformat(start)).days
    if not 0 < n_days <= MAX_CALENDAR_DAYS:
        raise ValueError(f"calendar of {n_days} days is out of bounds")
    d = F.col("date_day")
    dow = (F.dayofweek(d) - 1).cast("int")  # 0 = Sunday
    m = F.month(d)
    return (spark.range(n_days)
            .select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_day"))
            .select(
                d,
                date_key(d).alias("date_sk"),
                F.year(d).cast("int").alias("year"),
                F.quarter(d).cast("int").alias("quarter"),
                m.cast("int").alias("month"),
                F.date_format(d, "MMM").alias("month_name"),
                F.dayofmonth(d).cast("int").alias("day_of_month"),
                dow.alias("day_of_week"),
                F.date_format(d, "EEE").alias("day_name"),
                F.weekofyear(d).cast("int").alias("week_of_year"),
                F.dayofyear(d).cast("int").alias("day_of_year"),
                dow.isin(0, 6).alias("is_weekend"),
                (F.last_day(d) == d).alias("is_month_end"),
                F.when(m >= FISCAL_YEAR_START_MONTH, F.year(d)).otherwise(F.year(d) - 1)
                 .cast("int").alias("fiscal_year"),
                F.when(m.between(3, 5), 1).when(m.between(6, 8), 2).when(m.between(9, 11), 3)
                 .otherwise(4).cast("int").alias("fiscal_quarter"),
                F.trunc(d, "month").alias("month_start"),
                F.last_day(d).alias("month_end"),
                F.trunc(d, "quarter").alias("quarter_start"),
                F.trunc(d, "year").alias("year_start"),
            ))


def dim_advisor(commissions: DataFrame, valuations: DataFrame, risk_policies: DataFrame,
                run_ts) -> DataFrame:
    """Distinct (company, advisor_identifier) over four sources."""
    keys = _union_all([
        src.select("company", "advisor_identifier").where(F.col("advisor_identifier").isNotNull())
        for src in (commissions, valuations, risk_policies)
    ]).distinct()
    return keys.select(
        surrogate_key("company", "advisor_identifier").alias("advisor_sk"),
        "advisor_identifier", "company", F.lit(run_ts).alias("_loaded_at"))


def birth_date_from_id(id_col) -> F.Column:
    """YYMMDD prefix -> date; YY <= 29 means 20YY, else 19YY; invalid -> NULL."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    head = F.substring(c, 1, 6)
    yy = F.substring(c, 1, 2).try_cast("int")
    text = F.when(head.rlike("^[0-9]{6}$"),
                  F.when(yy <= 29, F.concat(F.lit("20"), head)).otherwise(F.concat(F.lit("19"), head)))
    return F.try_to_date(text, "yyyyMMdd")


def dim_client(valuations: DataFrame, investment_txns: DataFrame, as_of, run_ts) -> DataFrame:
    """One row per (company, client_id_number), max() of each attribute."""
    cols = ["company", "client_id_number", "client_title", "client_first_name",
            "client_surname", "client_initials"]
    clients = _union_all([s.select(*cols).where(F.col("client_id_number").isNotNull())
                          for s in (valuations, investment_txns)])
    deduped = clients.groupBy("company", "client_id_number").agg(
        *[F.max(c).alias(c) for c in cols[2:]])
    full_name = F.trim(F.concat(
        F.coalesce(F.concat(F.col("client_title"), F.lit(" ")), F.lit("")),
        F.coalesce(F.concat(F.col("client_first_name"), F.lit(" ")), F.lit("")),
        F.coalesce(F.col("client_surname"), F.lit(""))))
    birth = birth_date_from_id("client_id_number")
    return (deduped
            .select(surrogate_key("company", "client_id_number").alias("client_sk"), *cols,
                    full_name.alias("client_full_name"), birth.alias("birth_date"))
            .withColumn("age_years", F.when(F.col("birth_date").isNotNull(),
                                            year_boundaries("birth_date", F.lit(as_of).cast("date"))))
            .withColumn("_loaded_at", F.lit(run_ts)))


def dim_fund(valuations: DataFrame, run_ts) -> DataFrame:
    """One row per (company, fund_name); ETF iff a JSE code exists."""
    funds = (valuations.where(F.col("fund_name").isNotNull())
             .groupBy("company", "fund_name")
             .agg(F.max("fund_code").alias("fund_code"), F.max("jse_code").alias("jse_code")))
    return funds.select(
        surrogate_key("company", "fund_name").alias("fund_sk"),
        "company", "fund_name", "fund_code", "jse_code",
        F.when(F.col("jse_code").isNotNull(), "ETF").otherwise("UNIT_TRUST").alias("fund_type"),
        F.lit(run_ts).alias("_loaded_at"))


def dim_product(valuations: DataFrame, risk_policies: DataFrame, run_ts) -> DataFrame:
    """Investment products (code, name) from valuations and insurance
    products (name only) from the risk masters; natural key
    coalesce(code, name) within (company, category)."""
    inv = (valuations.where(F.col("product_code").isNotNull() | F.col("product_name").isNotNull())
           .select("company", F.lit("INVESTMENT").alias("product_category"),
                   "product_code", "product_name"))
    ins = (risk_policies.where(F.col("product_name").isNotNull())
           .select("company", F.lit("INSURANCE").alias("product_category"),
                   F.lit(None).cast("string").alias("product_code"), "product_name"))
    nk = F.coalesce(F.col("product_code"), F.col("product_name"))
    deduped = (inv.unionByName(ins)
               .groupBy("company", "product_category", nk.alias("natural_key"))
               .agg(F.max("product_code").alias("product_code"),
                    F.max("product_name").alias("product_name")))
    return deduped.select(
        surrogate_key("company", "product_category", "natural_key").alias("product_sk"),
        "company", "product_category", "product_code", "product_name",
        F.lit(run_ts).alias("_loaded_at"))


# ------------------------------------------------------------------ D5
RISK_POLICY_ATTRIBUTES = [
    "inception_date", "policy_status", "member_id", "age_next", "smoker_status",
    "income_bracket", "product_name", "life_sum_assured", "life_premium",
    "disability_type", "disability_sum_assured", "disability_premium",
    "chronic_level", "chronic_waiting_period", "chronic_premium",
    "accident_benefit", "accident_premium", "total_monthly_premium",
    "commission_rate",
]
VALID_TO_OPEN = "9999-12-31 00:00:00"


def latest_risk_policies(risk_policies: DataFrame) -> DataFrame:
    """Latest load per (company, policy_number) by ``_loaded_at desc nulls
    last``, ties broken by every attribute so reruns are stable.

    ``max_by`` over a struct whose first field is the load stamp is a plain
    aggregate: partial aggregation on the map side, no window, and a hot
    policy key is pre-combined before the shuffle.  A NULL stamp
    loses to any real one (max ignores NULL only at the top level, so NULL is
    mapped to a sentinel that sorts first)."""
    payload = F.struct(*[F.col(c) for c in RISK_POLICY_ATTRIBUTES + ["_loaded_at", "advisor_identifier"]])
    return (risk_policies.where(F.col("policy_number").isNotNull())
            .groupBy("company", "policy_number")
            .agg(F.max_by(payload, latest_load_rank()).alias("p"))
            .select("company", "policy_number", "p.*")
            .drop("advisor_identifier"))


def latest_load_rank() -> F.Column:
    """Rank of a risk-master row: non-NULL load stamp first, latest stamp,
    then every attribute (and the advisor) so the pick is total."""
    return F.struct(F.col("_loaded_at").isNotNull().alias("has_ts"),
                    F.col("_loaded_at").alias("ts"),
                    *[F.col(c).alias(c) for c in RISK_POLICY_ATTRIBUTES + ["advisor_identifier"]])


def latest_risk_advisors(risk_policies: DataFrame) -> DataFrame:
    """(company, policy_number, advisor_identifier) of the latest load: the
    advisor the risk master carries, for the corrected policy fact."""
    return (risk_policies.where(F.col("policy_number").isNotNull())
            .groupBy("company", "policy_number")
            .agg(F.max_by("advisor_identifier", latest_load_rank()).alias("advisor_identifier")))


def dim_policy(risk_policies: DataFrame, valuations: DataFrame, investment_txns: DataFrame,
               run_ts) -> DataFrame:
    """RISK policies (latest load) plus INVESTMENT policy numbers seen in
    valuations/transactions that have no risk master row."""
    risk = latest_risk_policies(risk_policies).withColumn("policy_universe", F.lit("RISK"))
    inv_numbers = (valuations.select("company", "policy_number")
                   .unionByName(investment_txns.select("company", "policy_number"))
                   .where(F.col("policy_number").isNotNull())
                   .distinct())
    investment = (inv_numbers.join(risk.select("company", "policy_number"),
                                   ["company", "policy_number"], "left_anti")
                  .withColumn("policy_universe", F.lit("INVESTMENT"))
                  .withColumn("_loaded_at", F.lit(run_ts)))
    typed_nulls = {c: F.lit(None).cast(t) for c, t in risk.dtypes if c in RISK_POLICY_ATTRIBUTES}
    investment = investment.withColumns(typed_nulls)
    unioned = risk.unionByName(investment)
    return unioned.select(
        surrogate_key("company", "policy_number").alias("policy_sk"),
        "company", "policy_number", "policy_universe", *RISK_POLICY_ATTRIBUTES,
        F.lit(True).alias("is_current"),
        F.coalesce(F.col("_loaded_at"), F.lit(run_ts)).alias("valid_from"),
        F.lit(VALID_TO_OPEN).cast("timestamp_ntz").alias("valid_to"),
        "_loaded_at")
