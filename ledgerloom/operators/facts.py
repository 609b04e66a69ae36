"""Facts (F1-F4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import year_boundaries
from ..functions.keys import date_key, guarded_key, surrogate_key
from ..schemas import COMMISSION_CATEGORY
from .numbering import Order, row_in_grain

COMMISSION_FACT_COLUMNS = [
    "company", "commission_category", "commission_id", "policy_number", "advisor_identifier",
    "business_line", "commission_type", "transaction_date", "gross_amount", "vat_amount",
    "net_amount", "product_code", "commission_rate", "clawback_reason", "payment_reference",
    "payment_date", "brokerage_split", "status", "_loaded_at",
]


def commission_category(dataset_col="dataset"):
    c = F.col(dataset_col)
    expr = None
    for ds, cat in COMMISSION_CATEGORY.items():
        expr = F.when(c == ds, cat) if expr is None else expr.when(c == ds, cat)
    return expr


def fct_commissions(stg: DataFrame, guard_advisor: bool = False) -> DataFrame:
    """F1.  ``advisor_sk`` is hashed without a NULL guard, as in the
    reference (NULL advisors share one orphan key); ``guard_advisor=True`` is
    the corrected variant."""
    df = stg.withColumn("commission_category", commission_category())
    advisor = (guarded_key("advisor_identifier", "company", "advisor_identifier") if guard_advisor
               else surrogate_key("company", "advisor_identifier"))
    return df.select(
        surrogate_key("company", "commission_id").alias("commission_sk"),
        advisor.alias("advisor_sk"),
        guarded_key("policy_number", "company", "policy_number").alias("policy_sk"),
        date_key("transaction_date").alias("date_sk"),
        *COMMISSION_FACT_COLUMNS)


VALUATION_ORDER_TAIL = [
    "advisor_identifier", "client_id_number", "product_code", "product_name", "fund_code",
    "jse_code", "currency", "anniversary_month", "monthly_income_amount", "monthly_income_pct",
    "income_frequency", "client_title", "client_first_name", "client_surname", "client_initials",
]


def _valuation_keys() -> list:
    return [
        guarded_key("advisor_identifier", "company", "advisor_identifier").alias("advisor_sk"),
        F.when(F.coalesce("product_code", "product_name").isNotNull(),
               surrogate_key("company", F.lit("INVESTMENT"), F.coalesce("product_code", "product_name")))
        .alias("product_sk"),
        guarded_key("fund_name", "company", "fund_name").alias("fund_sk"),
        date_key("valuation_date").alias("date_sk"),
        guarded_key("policy_number", "company", "policy_number").alias("policy_sk"),
        guarded_key("client_id_number", "company", "client_id_number").alias("client_sk"),
        "company", "policy_number", "client_id_number", "valuation_date", "currency",
        "anniversary_month", "income_frequency",
        (F.col("policy_number").isNotNull() & F.col("valuation_date").isNotNull()).alias("has_complete_grain"),
        "market_value_amount", "units", "monthly_income_amount", "monthly_income_pct", "_loaded_at",
    ]


def valuations_keyed(stg: DataFrame) -> DataFrame:
    """F2 rows with every foreign key but without the grain disambiguator:
    a 1:1 projection of staging for consumers that never read
    ``valuation_sk`` (marts, BI measures), so they skip the numbering."""
    return stg.select(*_valuation_keys())


def fct_valuations(stg: DataFrame, plain_numbering: bool = False, draw=None) -> DataFrame:
    """K5 numbering inside (company, policy, fund, date), ordered by
    amount, units, load stamp (ASC, NULLs last) and then every remaining
    column so the order is total and reruns give the same keys.
    ``draw(fraction)`` may give a random part of ``stg`` (see K5)."""
    grain = [F.col("company"),
             F.coalesce(F.col("policy_number"), F.lit("_NULL_")),
             F.coalesce(F.col("fund_name"), F.lit("_NULL_")),
             F.coalesce(F.col("valuation_date"), F.lit("1900-01-01").cast("date"))]
    order = [Order(c) for c in ["market_value_amount", "units", "_loaded_at"] + VALUATION_ORDER_TAIL]
    numbered = row_in_grain(stg, grain, order, plain=plain_numbering, draw=draw)
    return numbered.select(
        surrogate_key("company", "policy_number", "fund_name", "valuation_date", "_row_in_grain")
        .alias("valuation_sk"),
        *_valuation_keys())


TXN_COLUMNS = [
    "company", "transaction_category", "transaction_id", "policy_number", "member_id",
    "client_id_number", "fund_code", "transaction_type", "transaction_date", "amount", "units",
    "price_per_unit", "status", "reference_number", "source_fund", "narrative", "claim_type",
    "claim_reason", "benefit_affected", "_loaded_at",
]


def transactions_union(risk_txns: DataFrame, investment_txns: DataFrame) -> DataFrame:
    """RISK and INVESTMENT transaction universes with typed NULLs for the
    columns of the other universe."""
    risk = risk_txns.withColumn("transaction_category", F.lit("RISK"))
    inv = investment_txns.withColumn("transaction_category", F.lit("INVESTMENT"))
    risk = risk.select(*[c for c in TXN_COLUMNS if c in risk.columns])
    inv = inv.select(*[c for c in TXN_COLUMNS if c in inv.columns])
    return risk.unionByName(inv, allowMissingColumns=True).select(*TXN_COLUMNS)


def fund_lookup(dim_fund: DataFrame) -> DataFrame:
    """(company, fund_code) -> min(fund_name); tiny, one row per code."""
    return (dim_fund.where(F.col("fund_code").isNotNull())
            .groupBy("company", "fund_code").agg(F.min("fund_name").alias("lookup_fund_name")))


TXN_ORDER = [Order("transaction_date"), Order("amount"), Order("_loaded_at")] + [
    Order(c) for c in ["transaction_category", "policy_number", "member_id", "client_id_number",
                       "fund_code", "transaction_type", "units", "price_per_unit", "status",
                       "reference_number", "source_fund", "narrative", "claim_type",
                       "claim_reason", "benefit_affected"]]


def _transaction_columns(lk: DataFrame, rows: DataFrame) -> DataFrame:
    joined = rows.join(lk, ["company", "fund_code"], "left")
    return joined.select(
        guarded_key("policy_number", "company", "policy_number").alias("policy_sk"),
        guarded_key("client_id_number", "company", "client_id_number").alias("client_sk"),
        guarded_key("lookup_fund_name", "company", "lookup_fund_name").alias("fund_sk"),
        date_key("transaction_date").alias("date_sk"),
        "company", "transaction_category", "transaction_id", "policy_number", "member_id",
        "client_id_number", "fund_code", "transaction_type", "transaction_date", "status",
        "reference_number", "source_fund", "narrative", "claim_type", "claim_reason",
        "benefit_affected",
        F.col("transaction_id").isNotNull().alias("has_complete_grain"),
        "amount", "units", "price_per_unit", "_loaded_at",
        *(["_row_in_grain"] if "_row_in_grain" in rows.columns else []))


def transactions_keyed(risk_txns: DataFrame, investment_txns: DataFrame, dim_fund: DataFrame) -> DataFrame:
    """F3 rows with every foreign key but without ``transaction_sk``: the
    vault and the roll-ups key on (company, transaction_id) and skip the
    numbering."""
    return _transaction_columns(fund_lookup(dim_fund), transactions_union(risk_txns, investment_txns))


def fct_transactions(risk_txns: DataFrame, investment_txns: DataFrame, dim_fund: DataFrame,
                     plain_numbering: bool = False, draw=None) -> DataFrame:
    """both universes, K5 numbering over (company, transaction_id) (all
    NULL ids of a tenant form one grain), fund name resolved through the (company, fund_code) lookup
    (one row per code, so the join never multiplies rows)."""
    numbered = transactions_numbered(risk_txns, investment_txns, plain_numbering, draw)
    keyed = _transaction_columns(fund_lookup(dim_fund), numbered)
    return keyed.select(surrogate_key("company", "transaction_id", "_row_in_grain").alias("transaction_sk"),
                        *[c for c in keyed.columns if c != "_row_in_grain"])


def transactions_numbered(risk_txns: DataFrame, investment_txns: DataFrame,
                          plain_numbering: bool = False, draw=None, alone_as: str | None = None) -> DataFrame:
    """Both universes with K5's row number inside (company, transaction_id).
    ``draw(fraction)`` may give a random part of (risk, investment) rows;
    ``alone_as``: see K5."""
    grain = [F.col("company"), F.coalesce(F.col("transaction_id"), F.lit("_NULL_"))]
    some = (lambda part: transactions_union(*draw(part))) if draw else None
    return row_in_grain(transactions_union(risk_txns, investment_txns), grain, TXN_ORDER,
                        plain=plain_numbering, draw=some, alone_as=alone_as)


def fct_policies(dim_policy: DataFrame, commissions: DataFrame, valuations: DataFrame,
                 transactions: DataFrame, as_of, run_ts, fix_advisor: bool = False,
                 risk_advisors: DataFrame | None = None) -> DataFrame:
    """policy-grain accumulating snapshot.

    The roll-ups are grouped by (company, policy_number) and the policy
    dimension is joined on the same columns, so they share one hash
    partitioning and no key is hashed before a shuffle.  The latest market value is a ``max_by`` aggregate folded
    into the valuation roll-up (no window, partial aggregation).  The snapshot date is a literal column,
    not a cross join.  ``advisor_sk`` is always NULL as in the reference
    (trap 1); ``fix_advisor=True`` resolves it from the latest risk-master
    row (``risk_advisors``: company, policy_number, advisor_identifier)."""
    key = ["company", "policy_number"]
    cr = (commissions.where(F.col("policy_number").isNotNull())
          .groupBy("company", "policy_number")
          .agg(F.count(F.lit(1)).alias("commission_count"),
               F.sum("gross_amount").cast("decimal(38,2)").alias("commission_gross_total"),
               F.sum("net_amount").cast("decimal(38,2)").alias("commission_net_total"),
               F.max("transaction_date").alias("last_commission_date")))
    # After (date, load stamp) the value itself breaks ties: equal ranks
    # then give the same latest_market_value whichever row wins.
    latest_rank = F.struct(F.col("valuation_date").isNotNull(), F.col("valuation_date"),
                           F.col("_loaded_at").isNotNull(), F.col("_loaded_at"),
                           F.col("market_value_amount"))
    vr = (valuations.where(F.col("policy_number").isNotNull())
          .groupBy("company", "policy_number")
          .agg(F.count(F.lit(1)).alias("valuation_count"),
               F.round(F.avg("market_value_amount").cast("double"), 6).alias("avg_market_value"),
               F.max("valuation_date").alias("last_valuation_date"),
               F.max_by("market_value_amount", latest_rank).alias("latest_market_value")))
    tr = (transactions.where(F.col("policy_number").isNotNull())
          .groupBy("company", "policy_number")
          .agg(F.count(F.lit(1)).alias("transaction_count"),
               F.sum("amount").cast("decimal(38,2)").alias("transaction_amount_total"),
               F.max("transaction_date").alias("last_transaction_date")))
    p = dim_policy
    snap = F.lit(as_of).cast("date")
    if fix_advisor and risk_advisors is not None:
        adv = risk_advisors.select(*key, guarded_key("advisor_identifier", "company",
                                                    "advisor_identifier").alias("advisor_sk_fixed"))
        p = p.join(adv, key, "left")
        advisor_sk = F.col("advisor_sk_fixed")
    else:
        advisor_sk = F.lit(None).cast("string")
    out = p.join(cr, key, "left").join(vr, key, "left").join(tr, key, "left")
    return out.select(
        "policy_sk",
        date_key(snap).alias("date_sk"),
        snap.alias("snapshot_date"),
        advisor_sk.cast("string").alias("advisor_sk"),
        "company", "policy_number", "policy_universe", "policy_status", "inception_date",
        F.when(F.col("inception_date").isNotNull(), year_boundaries("inception_date", snap))
         .alias("policy_age_years"),
        "product_name", "total_monthly_premium", "life_sum_assured", "life_premium",
        "disability_sum_assured", "disability_premium", "chronic_premium", "accident_premium",
        F.coalesce(F.col("commission_count"), F.lit(0)).alias("commission_count"),
        "commission_gross_total", "commission_net_total", "last_commission_date",
        F.coalesce(F.col("valuation_count"), F.lit(0)).alias("valuation_count"),
        "avg_market_value", "latest_market_value", "last_valuation_date",
        F.coalesce(F.col("transaction_count"), F.lit(0)).alias("transaction_count"),
        "transaction_amount_total", "last_transaction_date",
        F.lit(run_ts).alias("_loaded_at"))
