"""Feed shapes and the tenant registry.

Every landing feed is a fixed, ordered list of string columns (loaded by
position) plus a ``_loaded_at`` stamp.  Types are imposed only in staging.
Six shapes exist; each tenant ships each shape under its own dataset name.
"""

from __future__ import annotations

from dataclasses import dataclass


# --- fixed values: tenant codes, in registry order (index = key % 3) -------
TENANTS = ["MAIN_BOOK", "INDIGO_INSURANCE", "HORIZON_ASSURANCE"]

# --- fixed values: landing column order per feed shape ---------------------
COMMISSION_COLUMNS = [
    "commission_id", "policy_number", "advisor_identifier", "business_line",
    "commission_type", "transaction_date", "gross_amount", "vat_amount",
    "net_amount", "product_code", "commission_rate", "clawback_reason",
    "payment_reference", "payment_date", "brokerage_split", "status",
    "client_title", "client_first_name", "client_surname", "client_initials",
]
VALUATION_COLUMNS = [
    "advisor_identifier", "client_title", "client_first_name", "client_surname",
    "client_initials", "client_id_number", "policy_number", "product_name",
    "product_code", "fund_name", "fund_code", "jse_code", "valuation_date",
    "currency", "market_value_amount", "units", "anniversary_month",
    "monthly_income_amount", "monthly_income_pct", "income_frequency",
]
INVESTMENT_TXN_COLUMNS = [
    "transaction_id", "policy_number", "client_id_number", "fund_code",
    "transaction_type", "transaction_date", "amount", "units",
    "price_per_unit", "status", "reference_number", "source_fund",
    "narrative", "client_title", "client_first_name", "client_surname",
    "client_initials",
]
RISK_TXN_COLUMNS = [
    "transaction_id", "policy_number", "member_id", "transaction_type",
    "transaction_date", "amount", "status", "reference_number",
    "narrative", "claim_type", "claim_reason", "benefit_affected",
    "client_title", "client_first_name", "client_surname", "client_initials",
]
RISK_POLICY_COLUMNS_WITH_PRODUCT = [
    "policynumber", "inceptiondate", "policystatus", "memberid",
    "agenext", "smokerstatus", "incomebrackets", "productname",
    "life_sumassured", "life_premium", "disability_type",
    "disability_sumassured", "disability_premium", "chronic_level",
    "chronic_waitingperiod", "chronic_premium", "accident_benefit",
    "accident_premium", "total_monthlypremium", "commission_rate",
    "advisor_identifier", "client_title", "client_first_name",
    "client_surname", "client_initials",
]
RISK_POLICY_COLUMNS = [c for c in RISK_POLICY_COLUMNS_WITH_PRODUCT if c != "productname"]

# --- fixed values: landing → typed renames of the risk-policy shape -------
RISK_POLICY_RENAMES = {
    "policynumber": "policy_number",
    "inceptiondate": "inception_date",
    "policystatus": "policy_status",
    "memberid": "member_id",
    "agenext": "age_next",
    "smokerstatus": "smoker_status",
    "incomebrackets": "income_bracket",
    "productname": "product_name",
    "life_sumassured": "life_sum_assured",
    "disability_sumassured": "disability_sum_assured",
    "chronic_waitingperiod": "chronic_waiting_period",
    "total_monthlypremium": "total_monthly_premium",
}

MONEY = "decimal(18,2)"
QUANTITY = "decimal(18,4)"
RATE = "decimal(8,4)"

# --- fixed values: typed columns per shape (typed name -> Spark type); untagged = string
COMMISSION_TYPES = {
    "transaction_date": "date", "gross_amount": MONEY, "vat_amount": MONEY,
    "net_amount": MONEY, "commission_rate": RATE, "payment_date": "date",
    "brokerage_split": RATE,
}
VALUATION_TYPES = {
    "valuation_date": "date", "market_value_amount": MONEY, "units": QUANTITY,
    "anniversary_month": "int", "monthly_income_amount": MONEY,
    "monthly_income_pct": RATE,
}
INVESTMENT_TXN_TYPES = {
    "transaction_date": "date", "amount": MONEY, "units": QUANTITY,
    "price_per_unit": QUANTITY,
}
RISK_TXN_TYPES = {"transaction_date": "date", "amount": MONEY}
RISK_POLICY_TYPES = {
    "inception_date": "date", "age_next": "int", "life_sum_assured": MONEY,
    "life_premium": MONEY, "disability_sum_assured": MONEY,
    "disability_premium": MONEY, "chronic_premium": MONEY,
    "accident_benefit": MONEY, "accident_premium": MONEY,
    "total_monthly_premium": MONEY, "commission_rate": RATE,
}


@dataclass(frozen=True)
class Feed:
    """One landing dataset of one tenant."""

    tenant: str
    dataset: str
    shape: str
    columns: tuple[str, ...]
    file_regex: str


SHAPE_COLUMNS = {
    "commissions": COMMISSION_COLUMNS,
    "valuations": VALUATION_COLUMNS,
    "investment_transactions": INVESTMENT_TXN_COLUMNS,
    "risk_transactions": RISK_TXN_COLUMNS,
    "risk_policies": RISK_POLICY_COLUMNS_WITH_PRODUCT,
}

# --- fixed values: dataset names and file-name patterns per tenant ---------
# (tenant, dataset, shape, file-name regex).  The risk master of MAIN_BOOK
# must match the exact tail so it does not also take the
# ``risk_benefits_transactions`` files.
_FEED_TABLE = [
    ("MAIN_BOOK", "ins_commissions", "commissions", r".*main_book_ins_commissions.*[.]csv"),
    ("MAIN_BOOK", "inv_commissions", "commissions", r".*main_book_inv_commissions.*[.]csv"),
    ("MAIN_BOOK", "risk_benefits", "risk_policies", r".*main_book_risk_benefits[.]csv"),
    ("MAIN_BOOK", "risk_benefits_transactions", "risk_transactions", r".*main_book_risk_benefits_transactions.*[.]csv"),
    ("MAIN_BOOK", "valuation_transactions", "investment_transactions", r".*main_book_valuation_transactions.*[.]csv"),
    ("MAIN_BOOK", "valuations", "valuations", r".*main_book_valuations.*[.]csv"),
    ("INDIGO_INSURANCE", "ins_commissions", "commissions", r".*indigo_ins_commissions.*[.]csv"),
    ("INDIGO_INSURANCE", "inv_commissions", "commissions", r".*indigo_inv_commissions.*[.]csv"),
    ("INDIGO_INSURANCE", "insurance", "risk_policies", r".*indigo_insurance.*[.]csv"),
    ("INDIGO_INSURANCE", "ins_transactions", "risk_transactions", r".*indigo_ins_transactions.*[.]csv"),
    ("INDIGO_INSURANCE", "transactions", "investment_transactions", r".*indigo_transactions.*[.]csv"),
    ("INDIGO_INSURANCE", "valuations", "valuations", r".*indigo_valuations.*[.]csv"),
    ("HORIZON_ASSURANCE", "ins_commissions", "commissions", r".*horizon_ins_commissions.*[.]csv"),
    ("HORIZON_ASSURANCE", "inv_commissions", "commissions", r".*horizon_inv_commissions.*[.]csv"),
    ("HORIZON_ASSURANCE", "assurance", "risk_policies", r".*horizon_assurance.*[.]csv"),
    ("HORIZON_ASSURANCE", "ins_transactions", "risk_transactions", r".*horizon_ins_transactions.*[.]csv"),
    ("HORIZON_ASSURANCE", "transactions", "investment_transactions", r".*horizon_transactions.*[.]csv"),
    ("HORIZON_ASSURANCE", "valuations", "valuations", r".*horizon_valuations.*[.]csv"),
]


def _columns_for(tenant: str, shape: str) -> tuple[str, ...]:
    if shape == "risk_policies" and tenant == "MAIN_BOOK":
        return tuple(RISK_POLICY_COLUMNS)
    return tuple(SHAPE_COLUMNS[shape])


FEEDS = [Feed(t, d, s, _columns_for(t, s), rx) for t, d, s, rx in _FEED_TABLE]

# Feed dataset -> commission category (the only thing the feed name adds).
COMMISSION_CATEGORY = {"ins_commissions": "INSURANCE", "inv_commissions": "INVESTMENT"}
