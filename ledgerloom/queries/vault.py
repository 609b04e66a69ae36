"""Registered queries: vault (V1-V9) and SCD-2.

Run 1 loads the base fixtures at RUN1; run 2 loads the mutated fixtures
(``variant=1``) at RUN2.  A run-2 query returns the table after both runs:
the run-1 content plus the guarded delta of run 2."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import REGISTRY, register
from ..functions.keys import hashdiff, surrogate_key
from ..oracle import vault_sql as VS
from ..oracle.warehouse_sql import hashdiff as sql_hashdiff
from ..oracle.warehouse_sql import sk
from ..operators import scd
from ..operators import vault as V
from ..plans.tables import COMPACT, stage
from ..plans.warehouse import Warehouse

RUN1 = "2024-06-30 00:00:00"
RUN2 = "2024-07-31 00:00:00"


def stored(df):
    """Run-1 output as a written table in the shared folder: run 2 reads it
    instead of recomputing it, as it would read the real target table."""
    return stage(df, "run1", **COMPACT)


def _wh(spark, sf, run: int) -> Warehouse:
    return (Warehouse.from_fixtures(spark, sf, run_ts=RUN1) if run == 1
            else Warehouse.from_fixtures(spark, sf, variant=1, run_ts=RUN2))


def _hub(name):
    h = V.HUBS[name]

    def run1(spark, sf):
        w = _wh(spark, sf, 1)
        return V.insert_only_delta(V.hub_candidates(w.transactions_keyed, h, w.run_ts), None, h.hk)

    def run2(spark, sf):
        first = stored(run1(spark, sf))
        w2 = _wh(spark, sf, 2)
        delta = V.insert_only_delta(V.hub_candidates(w2.transactions_keyed, h, w2.run_ts), first, h.hk)
        return first.unionByName(delta)
    return h, run1, run2


for _i, _name in enumerate(["hub_transaction", "hub_policy", "hub_client", "hub_fund"], start=1):
    _h, _r1, _r2 = _hub(_name)
    register(f"v{_i}_{_name}", VS.hub_sql(_h.hk, list(_h.keys), "fct_transactions", VS.RUN1))(_r1)
    register(f"v{_i}_{_name}_run2",
             f"SELECT * FROM ({VS.hub_sql(_h.hk, list(_h.keys), 'fct_transactions', VS.RUN1)}) a "
             f"UNION ALL SELECT * FROM ({VS.hub_sql(_h.hk, list(_h.keys), 'fct_transactions_v1', VS.RUN2)}) b "
             f"WHERE b.{_h.hk} NOT IN (SELECT {_h.hk} FROM ({VS.hub_sql(_h.hk, list(_h.keys), 'fct_transactions', VS.RUN1)}))")(_r2)


def _link(name):
    lk = V.LINKS[name]

    def run1(spark, sf):
        w = _wh(spark, sf, 1)
        return V.insert_only_delta(V.link_candidates(w.transactions_keyed, lk, w.run_ts), None, lk.hk)

    def run2(spark, sf):
        first = stored(run1(spark, sf))
        w2 = _wh(spark, sf, 2)
        delta = V.insert_only_delta(V.link_candidates(w2.transactions_keyed, lk, w2.run_ts), first, lk.hk)
        return first.unionByName(delta)
    return lk, run1, run2


for _i, _name in zip((5, 6, 7), ["lnk_transaction_policy", "lnk_transaction_client", "lnk_transaction_fund"]):
    _l, _r1, _r2 = _link(_name)
    _hubs = [(n, list(k)) for n, k in _l.hubs]
    _s1 = VS.link_sql(_l.hk, list(_l.keys), _hubs, "fct_transactions", VS.RUN1)
    _s2 = VS.link_sql(_l.hk, list(_l.keys), _hubs, "fct_transactions_v1", VS.RUN2)
    register(f"v{_i}_{_name}", _s1)(_r1)
    register(f"v{_i}_{_name}_run2",
             f"SELECT * FROM ({_s1}) a UNION ALL SELECT * FROM ({_s2}) b "
             f"WHERE b.{_l.hk} NOT IN (SELECT {_l.hk} FROM ({_s1}))")(_r2)


def _fact(w, collapse):
    # the collapsed form picks the last row of a key's grain order, so it
    # needs numbered rows; the row-grain form only needs keyed rows
    return w.transactions_numbered if collapse else w.transactions_keyed


def _sat(cols, collapse=False):
    def run1(spark, sf):
        w = _wh(spark, sf, 1)
        return V.satellite_delta(V.satellite_source(_fact(w, collapse), cols, w.run_ts, collapse), None)

    def run2(spark, sf):
        first = stored(run1(spark, sf))
        w2 = _wh(spark, sf, 2)
        src2 = V.satellite_source(_fact(w2, collapse), cols, w2.run_ts, collapse)
        return first.unionByName(V.satellite_delta(src2, first))
    return run1, run2


for _i, _name, _cols, _cte in ((8, "sat_transaction_details", V.SAT_DETAILS_COLUMNS, "sat_details"),
                               (9, "sat_transaction_amounts", V.SAT_AMOUNTS_COLUMNS, "sat_amounts")):
    _r1, _r2 = _sat(_cols)
    register(f"v{_i}_{_name}", f"SELECT * FROM {_cte}_run1")(_r1)
    register(f"v{_i}_{_name}_run2", f"SELECT * FROM {_cte}_run2")(_r2)
    _f1, _f2 = _sat(_cols, collapse=True)
    register(f"v{_i}_{_name}_run2_fixed", f"SELECT * FROM {_cte}_fixed_run2")(_f2)


# ------------------------------------------------------------------ SCD-2
def snapshot_after_run1(spark, sf):
    w = _wh(spark, sf, 1)
    return scd.snapshot_run(None, w.dim_policy, w.run_ts)


def snapshot_after_run2(spark, sf):
    first = stored(snapshot_after_run1(spark, sf))
    w2 = _wh(spark, sf, 2)
    return scd.snapshot_run(first, w2.dim_policy, w2.run_ts)


register("h1_snp_dim_policy", "SELECT * FROM snp_run1")(snapshot_after_run1)
register("h1_snp_dim_policy_run2", "SELECT * FROM snp_run2")(snapshot_after_run2)


@register("d7_dim_policy_history", "SELECT * FROM policy_history")
def d7(spark, sf):
    return scd.dim_policy_history(snapshot_after_run2(spark, sf))


@register("d8_policy_as_of", """
SELECT * FROM policy_history
WHERE valid_from <= TIMESTAMP '2024-07-15 00:00:00' AND TIMESTAMP '2024-07-15 00:00:00' < valid_to""")
def d8(spark, sf):
    return scd.policy_as_of(scd.dim_policy_history(snapshot_after_run2(spark, sf)), "2024-07-15 00:00:00")


@register("d8_policy_as_of_run2", f"""
SELECT * FROM policy_history WHERE valid_from <= {VS.RUN2} AND {VS.RUN2} < valid_to""")
def d8_run2(spark, sf):
    return scd.policy_as_of(scd.dim_policy_history(snapshot_after_run2(spark, sf)), RUN2)


@register("d8_point_in_time_join", """
SELECT f.policy_sk, f.snapshot_date, f.policy_status, h.policy_status AS pit_policy_status,
  h.policy_version_id AS pit_policy_version_id, h.valid_from AS pit_valid_from
FROM fct_policies f
LEFT JOIN policy_history h
  ON f.policy_sk = h.policy_sk AND h.valid_from <= CAST(f.snapshot_date AS TIMESTAMP)
 AND CAST(f.snapshot_date AS TIMESTAMP) < h.valid_to""")
def d8_join(spark, sf):
    """Each policy-fact row joined to the policy version valid at its
    snapshot date (equi-join on the key plus the validity range)."""
    hist = scd.dim_policy_history(snapshot_after_run2(spark, sf))
    f = _wh(spark, sf, 1).fct_policies.select("policy_sk", "snapshot_date", "policy_status")
    j = scd.point_in_time_join(f, hist, "snapshot_date")
    return j.select("policy_sk", "snapshot_date", "policy_status", "pit_policy_status",
                    F.col("pit_policy_version_id"), "pit_valid_from")


@register("k4_transaction_hashdiffs", f"""
SELECT {sk('company', 'transaction_id')} AS transaction_hk, {sql_hashdiff(*V.SAT_DETAILS_COLUMNS)} AS details_hashdiff,
  {sql_hashdiff(*V.SAT_AMOUNTS_COLUMNS)} AS amounts_hashdiff
FROM fct_transactions WHERE transaction_id IS NOT NULL""")
def k4(spark, sf):
    """K4: the descriptive and the measure hashdiff of every keyed
    transaction row."""
    rows = _wh(spark, sf, 1).transactions_keyed.where(F.col("transaction_id").isNotNull())
    return rows.select(surrogate_key("company", "transaction_id").alias("transaction_hk"),
                       hashdiff(*V.SAT_DETAILS_COLUMNS).alias("details_hashdiff"),
                       hashdiff(*V.SAT_AMOUNTS_COLUMNS).alias("amounts_hashdiff"))


# ------------------------------------------------------------------ stored runs
def _two_runs(spark, sf, write):
    """A store after both runs, each published, the second one retried."""
    import uuid

    from ..plans.build import TableStore, run_id_of
    from ..session import shared_path
    store = TableStore(spark, shared_path(spark, "stage", f"vault-{uuid.uuid4().hex}"))
    for run, ts in ((1, RUN1), (2, RUN2), (2, RUN2)):
        write(store, _wh(spark, sf, run), run_id_of(ts))
        store.publish(run_id_of(ts))
    return store


def _stored_keys(x, candidates):
    from ..plans.buckets import KeySet
    return lambda spark, sf: _two_runs(spark, sf, lambda store, w, rid: KeySet(store, x.name, x.hk).append(
        candidates(w.transactions_keyed, x, w.run_ts), rid)).every_run(x.name)


def _stored_versions(name, cols):
    from ..plans.buckets import append_versions
    return lambda spark, sf: _two_runs(spark, sf, lambda store, w, rid: append_versions(
        store, name, "transaction_hk", V.satellite_source(w.transactions_keyed, cols, w.run_ts), rid)).every_run(name)


@register("h1_snp_dim_policy_stored_run2", "SELECT * FROM snp_run2")
def h1_stored(spark, sf):
    """H1 through the store: open versions rewritten by the bucket."""
    from ..plans.build import read_snapshot, take_snapshot
    return read_snapshot(_two_runs(spark, sf, lambda store, w, rid: take_snapshot(store, w.dim_policy, w.run_ts, rid)))


for _i, _x in enumerate([*V.HUBS.values(), *V.LINKS.values()], start=1):
    register(f"v{_i}_{_x.name}_stored_run2", REGISTRY[f"v{_i}_{_x.name}_run2"].body)(
        _stored_keys(_x, V.hub_candidates if isinstance(_x, V.Hub) else V.link_candidates))
for _i, (_name, _cols) in enumerate(V.SATELLITES.items(), start=8):
    register(f"v{_i}_{_name}_stored_run2", REGISTRY[f"v{_i}_{_name}_run2"].body)(_stored_versions(_name, _cols))
