"""The data tests declared for the warehouse's tables, by layer.

Fixed values: tables, columns, test kinds, severities and accepted values, in
the tables' order.  A line reads ``column: test, test``; ``?`` marks a test of
severity ``warn``; ``in NAME`` accepts the values of ``VALUES[NAME]``; ``-> t.c``
wants every value in column c of table t; ``with c`` wants the pair unique.
"""

from __future__ import annotations

from dataclasses import replace

from ..operators.quality import DataTest
from ..schemas import COMMISSION_CATEGORY, TENANTS

VALUES = {
    "TENANT": tuple(TENANTS), "CATEGORY": ("INSURANCE", "INVESTMENT"), "UNIVERSE": ("RISK", "INVESTMENT"),
    "FUND_TYPE": ("ETF", "UNIT_TRUST"),
}

CORE = """
dim_advisor
advisor_sk: not_null, unique
advisor_identifier: not_null
company: not_null, in TENANT
fct_commissions
commission_sk: not_null, unique
advisor_sk: not_null?, -> dim_advisor.advisor_sk?
policy_sk: -> dim_policy.policy_sk?
date_sk: -> dim_date.date_sk?
commission_id: not_null
company: not_null, in TENANT
commission_category: not_null, in CATEGORY
transaction_date: not_null
gross_amount: not_null
dim_product
product_sk: not_null, unique
company: not_null, in TENANT
product_category: not_null, in CATEGORY
dim_fund
fund_sk: not_null, unique
fund_name: not_null
company: not_null, in TENANT
fund_type: not_null, in FUND_TYPE
dim_date
date_day: not_null, unique
date_sk: not_null, unique
year: not_null
fiscal_year: not_null
fct_valuations
valuation_sk: not_null, unique
advisor_sk: -> dim_advisor.advisor_sk?
product_sk: -> dim_product.product_sk?
fund_sk: -> dim_fund.fund_sk?
date_sk: -> dim_date.date_sk?
policy_sk: -> dim_policy.policy_sk?
client_sk: -> dim_client.client_sk?
company: not_null, in TENANT
policy_number: not_null?
valuation_date: not_null?
market_value_amount: not_null?
dim_policy
policy_sk: not_null, unique
policy_number: not_null
company: not_null, in TENANT
policy_universe: not_null, in UNIVERSE
is_current: not_null
fct_transactions
transaction_sk: not_null, unique
policy_sk: -> dim_policy.policy_sk?
client_sk: -> dim_client.client_sk?
fund_sk: -> dim_fund.fund_sk?
date_sk: -> dim_date.date_sk?
company: not_null, in TENANT
transaction_category: not_null, in UNIVERSE
transaction_id: not_null?
fct_policies
policy_sk: not_null, unique, -> dim_policy.policy_sk
date_sk: not_null, -> dim_date.date_sk
company: not_null, in TENANT
policy_universe: not_null, in UNIVERSE
dim_client
client_sk: not_null, unique
client_id_number: not_null
company: not_null, in TENANT
"""

HISTORY = """
snp_dim_policy
policy_sk: not_null
dbt_scd_id: not_null, unique
dbt_valid_from: not_null
dbt_updated_at: not_null
dim_policy_history
policy_version_id: not_null, unique
policy_sk: not_null
company: not_null, in TENANT
is_current: not_null
valid_from: not_null
valid_to: not_null
"""

VAULT = """
hub_transaction
transaction_hk: not_null, unique
company: not_null, in TENANT
transaction_id: not_null
load_dts: not_null
record_source: not_null
hub_policy
policy_hk: not_null, unique
company: not_null, in TENANT
policy_number: not_null
hub_client
client_hk: not_null, unique
company: not_null
client_id_number: not_null
hub_fund
fund_hk: not_null, unique
company: not_null
fund_code: not_null
lnk_transaction_policy
transaction_policy_hk: not_null, unique
transaction_hk: not_null, -> hub_transaction.transaction_hk
policy_hk: not_null, -> hub_policy.policy_hk
lnk_transaction_client
transaction_client_hk: not_null, unique
transaction_hk: not_null, -> hub_transaction.transaction_hk
client_hk: not_null, -> hub_client.client_hk
lnk_transaction_fund
transaction_fund_hk: not_null, unique
transaction_hk: not_null, -> hub_transaction.transaction_hk
fund_hk: not_null, -> hub_fund.fund_hk
sat_transaction_details
transaction_hk: not_null, -> hub_transaction.transaction_hk, with load_dts?
load_dts: not_null
hashdiff: not_null
sat_transaction_amounts
transaction_hk: not_null, -> hub_transaction.transaction_hk, with load_dts?
load_dts: not_null
hashdiff: not_null
"""

MARTS = """
finance_advisor_commissions_monthly
mart_key: not_null, unique
company: not_null, in TENANT
commission_category: not_null, in CATEGORY
advisor_sk: not_null, -> dim_advisor.advisor_sk?
portfolio_aum_monthly
mart_key: not_null, unique
company: not_null, in TENANT
fund_sk: not_null, -> dim_fund.fund_sk
aum_amount: not_null
risk_policy_inforce
mart_key: not_null, unique
company: not_null, in TENANT
policy_count: not_null
"""

#: Declared on the raw landing rows, once per tenant (commissions: per dataset).
LANDING = """
raw_commissions
commission_id: not_null?
raw_risk_policies
policynumber: not_null?
raw_risk_transactions
transaction_id: not_null?
raw_investment_transactions
transaction_id: not_null?
raw_valuations
policy_number: not_null?
"""

#: Declared once per tenant.
STAGING = """
stg_commissions
commission_id: not_null, unique
stg_risk_policies
policy_number: not_null?
inception_date: not_null?
stg_risk_transactions
transaction_id: not_null?, unique?
transaction_date: not_null?
stg_investment_transactions
transaction_id: not_null?, unique?
amount: not_null?
stg_valuations
policy_number: not_null?
valuation_date: not_null?
market_value_amount: not_null?
"""


def declared(text: str, where: str | None = None, suffix: str = "") -> list[DataTest]:
    """The tests of a listing, on the rows that satisfy ``where``."""
    out, table = [], ""
    for line in text.strip().split("\n"):
        if ":" not in line:
            table = line
            continue
        column, tests = line.split(": ", 1)
        for item in tests.split(", "):
            severity, item = ("warn", item[:-1]) if item.endswith("?") else ("error", item)
            kind, columns, more = item, (column,), {}
            if item.startswith("in "):
                kind, more = "accepted_values", {"values": VALUES[item[3:]]}
            elif item.startswith("-> "):
                kind, more = "relationships", dict(zip(("to", "field"), item[3:].split(".")))
            elif item.startswith("with "):
                kind, columns = "unique_combination_of_columns", (column, item[5:])
            name = f"{kind}_{table}_{'__'.join(columns)}{suffix}"
            out.append(DataTest(kind, table, columns, severity, where, label=name, **more))
    return out


def staging_tests() -> list[DataTest]:
    """The staging tests of every tenant, and one that a single tenant has."""
    own = DataTest("not_null", "stg_investment_transactions", ("transaction_date",), "warn", "company = 'MAIN_BOOK'",
                   label="not_null_stg_investment_transactions_transaction_date_main_book")
    return [t for tenant in TENANTS for t in declared(STAGING, f"company = '{tenant}'", f"_{tenant.lower()}")] + [own]


def landing_tests() -> list[DataTest]:
    """The tests of the landing rows: six a tenant."""
    out = []
    for tenant in TENANTS:
        for t in declared(LANDING, f"company = '{tenant}'", f"_{tenant.lower()}"):
            if t.table != "raw_commissions":
                out.append(t)
                continue
            for dataset, category in COMMISSION_CATEGORY.items():
                out.append(replace(t, where=f"{t.where} AND dataset = '{dataset}'", label=f"{t.name}_{category.lower()}"))
    return out
