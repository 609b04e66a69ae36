"""The whole-warehouse build writes the same tables the registered queries compute."""

import pytest
from warehouse_data import SF_SMALL
from ledgerloom.catalog import load_all
from ledgerloom.operators.quality import DataTest
from ledgerloom.plans.build import BuildFailed, TableStore, build_warehouse, read_snapshot, run_id_of
from ledgerloom.plans.warehouse import Warehouse

RUN1, RUN2 = "2024-06-30 00:00:00", "2024-07-31 00:00:00"


def _same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    rows = lambda df: sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    return rows(a) == rows(b)


def test_two_runs_and_a_retry(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    reg = load_all()
    res1 = build_warehouse(Warehouse.from_fixtures(spark, SF_SMALL, run_ts=RUN1), store, RUN1)
    assert res1.where("status = 'FAIL'").count() == 0
    w2 = Warehouse.from_fixtures(spark, SF_SMALL, variant=1, run_ts=RUN2)
    build_warehouse(w2, store, RUN2)
    build_warehouse(w2, store, RUN2)          # retried run: same result, no duplicates
    sf = SF_SMALL
    assert _same(store.every_run("hub_transaction"), reg["v1_hub_transaction_run2"].fn(spark, sf))
    assert _same(store.every_run("sat_transaction_details"), reg["v8_sat_transaction_details_run2"].fn(spark, sf))
    assert _same(read_snapshot(store), reg["h1_snp_dim_policy_run2"].fn(spark, sf))
    for r in (RUN1, RUN2):
        assert store.published().count(run_id_of(r)) == 1
    # a failing error test keeps the run unseen; so does a run that stops half-way
    broken = [DataTest("accepted_values", "dim_policy", ("company",), values=("NONE",))]
    with pytest.raises(BuildFailed):
        build_warehouse(w2, store, "2024-08-31 00:00:00", tests=broken)
    store.write_run("dim_fund", spark.range(1), "20240930T000000")
    assert store.published() == [run_id_of(RUN1), run_id_of(RUN2)]
    assert store.latest("dim_fund").columns != ["id"]
    plan = store.latest("dim_fund")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    m1 = store.latest("finance_advisor_commissions_monthly")
    assert _same(m1.drop("_loaded_at"), reg["m1_finance_advisor_commissions_monthly"].fn(spark, sf).drop("_loaded_at"))
