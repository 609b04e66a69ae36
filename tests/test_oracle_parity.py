"""Spark result == DuckDB oracle (same fixture rules, same SQL semantics)."""

import pytest

from warehouse_data import SF_SMALL
from oracle_check import compare, duck
from ledgerloom.catalog import load_all

REGISTRY = load_all()
# A cross-section of every layer; tools/oracle_check.py runs them all.
SAMPLE = [
    "t1_stg_commissions", "t5_stg_risk_benefits", "k5_transaction_row_in_grain", "d2_dim_client",
    "d3_dim_date", "d5_dim_policy", "d6_dim_product", "f1_fct_commissions", "f2_fct_valuations",
    "f3_fct_transactions", "f4_fct_policies", "m1_finance_advisor_commissions_monthly",
    "m1_finance_advisor_commissions_monthly_fixed", "m2_portfolio_aum_monthly", "m3_risk_policy_inforce",
    "b8_top_funds_latest_month", "b13_semantic_net_by_tenant_category", "b16_mom_commission_calendar",
    "b19_commission_date_drill", "b20_advisor_year_matrix", "b22_commission_statement",
    "g1_g2_g3_dim_client_masked", "v1_hub_transaction_run2", "v8_sat_transaction_details_run2",
    "h1_snp_dim_policy_run2", "d8_policy_as_of", "x1_x6_core_quality_suite", "q1_quarantine_capture",
    "q4_alert_predicate", "s3_landing_risk_policies", "s5_rejected_rows_quarantined", "s7_ops_policies_replicated",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, con, name):
    q = REGISTRY[name]
    assert q.sql, f"{name} has no oracle"
    assert compare(spark, con, q, SF_SMALL, verbose=True)


def test_every_query_has_callable_and_most_have_oracles():
    with_sql = [n for n, q in REGISTRY.items() if q.sql]
    assert len(REGISTRY) >= 90
    assert len(with_sql) >= len(REGISTRY) - 3
