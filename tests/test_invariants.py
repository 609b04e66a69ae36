"""Warehouse invariants (the reference's reconciliation checks)."""

import pytest
from pyspark.sql import functions as F

from warehouse_data import SF_SMALL
from ledgerloom.plans.warehouse import Warehouse


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.from_fixtures(spark, SF_SMALL)


def _orphans(child, col, parent, pcol=None):
    pcol = pcol or col
    keys = parent.select(F.col(pcol).alias(col)).distinct()
    return child.where(F.col(col).isNotNull()).join(keys, col, "left_anti").count()


def test_policy_fact_has_one_row_per_policy(wh):
    assert wh.fct_policies.count() == wh.dim_policy.count()
    assert wh.fct_policies.select("policy_sk").distinct().count() == wh.dim_policy.count()


def test_policy_fact_commission_totals_reconcile(wh):
    known = wh.dim_policy.select("policy_sk")
    f1 = wh.fct_commissions.join(known, "policy_sk").agg(F.sum("net_amount")).first()[0]
    f4 = wh.fct_policies.agg(F.sum("commission_net_total")).first()[0]
    assert f1 == f4
    n1 = wh.fct_commissions.join(known, "policy_sk").count()
    assert wh.fct_policies.agg(F.sum("commission_count")).first()[0] == n1


def test_valuation_foreign_keys_resolve(wh):
    v = wh.fct_valuations
    assert _orphans(v, "fund_sk", wh.dim_fund) == 0
    assert _orphans(v, "advisor_sk", wh.dim_advisor) == 0
    assert _orphans(v, "client_sk", wh.dim_client) == 0
    assert _orphans(v, "policy_sk", wh.dim_policy) == 0
    assert _orphans(v, "product_sk", wh.dim_product) == 0
    assert _orphans(v, "date_sk", wh.dim_date) == 0


def test_known_orphans_are_the_documented_ones(wh):
    # trap 2: NULL advisors of commissions hash to one orphan key per tenant
    orphan_keys = (wh.fct_commissions.join(wh.dim_advisor.select("advisor_sk"), "advisor_sk", "left_anti")
                   .select("company", "advisor_identifier").distinct().collect())
    assert all(r.advisor_identifier is None for r in orphan_keys)
    # risk transactions may point at policies without a master row (expected warn)
    orphan_txn_policies = (wh.fct_transactions.where(F.col("policy_sk").isNotNull())
                           .join(wh.dim_policy.select("policy_sk"), "policy_sk", "left_anti"))
    assert orphan_txn_policies.where(F.col("transaction_category") != "RISK").count() == 0


def test_every_fact_row_is_kept(wh):
    assert wh.fct_valuations.count() == wh.stg_valuations.count()
    assert wh.fct_transactions.count() == (wh.stg_risk_transactions.count()
                                           + wh.stg_investment_transactions.count())
    assert wh.fct_transactions.select("transaction_sk").distinct().count() == wh.fct_transactions.count()
