"""Registered queries: data-quality suite (X1-X7) and quarantine (Q1-Q4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..oracle import vault_sql as VS
from ..oracle.cte import cte
from ..operators import quarantine as Q
from ..operators import vault as V
from ..operators.quality import DataTest, run_tests, suite_sql
from ..plans.declared_tests import CORE, HISTORY, MARTS, VAULT, declared, landing_tests, staging_tests
from ..schemas import TENANTS
from ..sources import fixtures
from ..sources.tables import TableSource
from .core import wh

# --------------------------------------------------------------- X1-X6 suite (fixed values: tables, columns, accepted values)
CORE_SUITE = [
    DataTest("not_null", "fct_commissions", ("commission_sk",)),
    DataTest("unique", "fct_commissions", ("commission_sk",)),
    DataTest("accepted_values", "fct_commissions", ("company",), values=tuple(TENANTS)),
    DataTest("accepted_values", "fct_commissions", ("commission_category",), values=("INSURANCE", "INVESTMENT")),
    # trap 2: NULL advisors hash to an orphan key -> expected warn
    DataTest("relationships", "fct_commissions", ("advisor_sk",), severity="warn",
             to="dim_advisor", field="advisor_sk"),
    DataTest("relationships", "fct_commissions", ("date_sk",), to="dim_date", field="date_sk",
             where="transaction_date >= DATE '2015-01-01'"),
    DataTest("unique", "dim_advisor", ("advisor_sk",)),
    DataTest("unique", "dim_policy", ("policy_sk",)),
    DataTest("accepted_values", "dim_policy", ("policy_universe",), values=("RISK", "INVESTMENT")),
    DataTest("accepted_values", "dim_policy", ("policy_status",), severity="warn",
             values=("Active", "Lapsed", "Cancelled", "Pending")),
    DataTest("unique", "fct_transactions", ("transaction_sk",)),
    DataTest("not_null", "fct_transactions", ("transaction_id",), severity="warn"),
    DataTest("relationships", "fct_transactions", ("policy_sk",), severity="warn",
             to="dim_policy", field="policy_sk"),
    DataTest("relationships", "fct_valuations", ("fund_sk",), to="dim_fund", field="fund_sk"),
    DataTest("unique", "fct_valuations", ("valuation_sk",)),
    DataTest("unique", "dim_client", ("client_sk",)),
    DataTest("not_null", "dim_client", ("birth_date",), severity="warn"),
    # trap 11: repeated transaction ids give several rows per (hk, load_dts)
    DataTest("unique_combination_of_columns", "sat_details_run1", ("transaction_hk", "load_dts"),
             severity="warn"),
]


def core_tables(w, tests):
    """The tables that ``tests`` name; the others are not built (a fact draws
    its numbering sample when it is built)."""
    make = {n: lambda n=n: getattr(w, n) for n in (
        "fct_commissions", "dim_advisor", "dim_date", "dim_policy", "fct_transactions", "fct_valuations", "dim_fund",
        "dim_client")}
    make["sat_details_run1"] = lambda: V.satellite_source(w.transactions_keyed, V.SAT_DETAILS_COLUMNS, w.run_ts)
    named = {t.table for t in tests} | {t.to for t in tests if t.to}
    return {n: rows() for n, rows in make.items() if n in named}


@register("x1_x6_core_quality_suite", suite_sql(CORE_SUITE))
def x_suite(spark, sf):
    return run_tests(core_tables(wh(spark, sf), CORE_SUITE), CORE_SUITE)


# --------------------------------------------------------------- declared tests, by layer
for _name, _hub in V.HUBS.items():
    cte(_name, VS.hub_sql(_hub.hk, list(_hub.keys), "fct_transactions", VS.RUN1))
for _name, _link in V.LINKS.items():
    cte(_name, VS.link_sql(_link.hk, list(_link.keys), [(n, list(k)) for n, k in _link.hubs], "fct_transactions", VS.RUN1))
for _name, _relation in (("sat_transaction_details", "sat_details_run1"), ("sat_transaction_amounts", "sat_amounts_run1"),
                         ("finance_advisor_commissions_monthly", "mart_finance"), ("portfolio_aum_monthly", "mart_aum"),
                         ("risk_policy_inforce", "mart_risk"), ("snp_dim_policy", "snp_run2"),
                         ("dim_policy_history", "policy_history")):
    cte(_name, f"SELECT * FROM {_relation}")


def _suite(name, tests, tables):
    @register(name, suite_sql(tests))
    def run(spark, sf):
        return run_tests(tables(spark, sf), tests)


def _vault_tables(spark, sf):
    rows = wh(spark, sf).transactions_keyed
    ts = F.lit("2024-06-30 00:00:00").cast("timestamp_ntz")
    return {**{n: V.hub_candidates(rows, h, ts) for n, h in V.HUBS.items()},
            **{n: V.link_candidates(rows, x, ts) for n, x in V.LINKS.items()},
            **{n: V.satellite_source(rows, c, ts) for n, c in V.SATELLITES.items()}}


def _history_tables(spark, sf):
    from ..operators import scd
    from .vault import snapshot_after_run2
    versions = snapshot_after_run2(spark, sf)
    return {"snp_dim_policy": versions, "dim_policy_history": scd.dim_policy_history(versions)}


_suite("x_declared_staging", staging_tests(), lambda spark, sf: {
    n: getattr(wh(spark, sf), n) for n in ("stg_commissions", "stg_risk_policies", "stg_risk_transactions",
                                           "stg_investment_transactions", "stg_valuations")})
for _shape in ("commissions", "risk_policies", "risk_transactions", "investment_transactions", "valuations"):
    cte(f"raw_{_shape}", f"SELECT * FROM fx_{_shape}")
_suite("x_declared_landing", landing_tests(), lambda spark, sf: {
    f"raw_{shape}": rows() for shape, rows in wh(spark, sf).landing.items()})
_suite("x_declared_core", declared(CORE), lambda spark, sf: {
    n: getattr(wh(spark, sf), n) for n in (
        "dim_advisor", "dim_date", "dim_product", "dim_fund", "dim_policy", "dim_client", "fct_commissions",
        "fct_valuations", "fct_transactions", "fct_policies")})
_suite("x_declared_vault", declared(VAULT), _vault_tables)
_suite("x_declared_history", declared(HISTORY), _history_tables)
_suite("x_declared_marts", declared(MARTS), lambda spark, sf: {
    n: getattr(wh(spark, sf), n) for n in ("finance_advisor_commissions_monthly", "portfolio_aum_monthly",
                                           "risk_policy_inforce", "dim_advisor", "dim_fund")})


# --------------------------------------------------------------- X7 ops constraints
cte("ops_policies", """
SELECT c_custkey + 1 AS policy_id, 'POL-' || lpad(CAST(c_custkey + 1 AS VARCHAR), 8, '0') AS policy_number,
  CASE c_custkey % 7 WHEN 4 THEN 'LAPSED' WHEN 5 THEN 'CANCELLED' WHEN 6 THEN 'PAID_UP'
       WHEN 3 THEN 'REINSTATED' ELSE 'ACTIVE' END AS status
FROM customer""")
cte("ops_claims", """
SELECT o_orderkey + 1 AS claim_id, 'CLM-' || lpad(CAST(o_orderkey + 1 AS VARCHAR), 9, '0') AS claim_reference,
  o_custkey + 1 + (CASE WHEN o_orderkey % 97 = 0 THEN 1000000000 ELSE 0 END) AS policy_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'DEATH' WHEN 1 THEN 'DISABILITY' WHEN 2 THEN 'CHRONIC' WHEN 3 THEN 'ACCIDENT'
       ELSE 'SURRENDER' END AS claim_type,
  CASE o_orderkey % 6 WHEN 0 THEN 'LODGED' WHEN 1 THEN 'ASSESSING' WHEN 2 THEN 'APPROVED' WHEN 3 THEN 'REJECTED'
       WHEN 4 THEN 'PAID' WHEN 5 THEN CASE WHEN o_orderkey % 5 > 0 THEN 'REOPENED' END END AS claim_status,
  CAST(o_orderdate AS TIMESTAMP) AS lodged_at
FROM orders""")

OPS_SUITE = [
    DataTest("unique", "ops_policies", ("policy_id",)),
    DataTest("unique", "ops_policies", ("policy_number",)),
    DataTest("accepted_values", "ops_policies", ("status",), values=("ACTIVE", "LAPSED", "CANCELLED", "PAID_UP")),
    DataTest("unique", "ops_claims", ("claim_reference",)),
    DataTest("accepted_values", "ops_claims", ("claim_type",),
             values=("DEATH", "DISABILITY", "CHRONIC", "ACCIDENT", "SURRENDER")),
    DataTest("accepted_values", "ops_claims", ("claim_status",),
             values=("LODGED", "ASSESSING", "APPROVED", "REJECTED", "PAID")),
    *[DataTest("not_null", "ops_claims", (c,)) for c in (
        "claim_id", "claim_reference", "policy_id", "claim_type", "claim_status", "lodged_at")],
    DataTest("relationships", "ops_claims", ("policy_id",), to="ops_policies", field="policy_id"),
]


def ops_tables(spark, sf):
    t = TableSource(spark, sf)
    c, o = t("customer"), t("orders")
    k = F.col("c_custkey")
    m7 = k % 7
    policies = c.select(
        (k + 1).alias("policy_id"),
        F.concat(F.lit("POL-"), F.lpad((k + 1).cast("string"), 8, "0")).alias("policy_number"),
        F.when(m7 == 4, "LAPSED").when(m7 == 5, "CANCELLED").when(m7 == 6, "PAID_UP")
         .when(m7 == 3, "REINSTATED").otherwise("ACTIVE").alias("status"))
    ok = F.col("o_orderkey")
    m5 = ok % 5
    claims = o.select(
        (ok + 1).alias("claim_id"),
        F.concat(F.lit("CLM-"), F.lpad((ok + 1).cast("string"), 9, "0")).alias("claim_reference"),
        (F.col("o_custkey") + 1 + F.when(ok % 97 == 0, F.lit(1000000000)).otherwise(F.lit(0))).alias("policy_id"),
        F.when(m5 == 0, "DEATH").when(m5 == 1, "DISABILITY").when(m5 == 2, "CHRONIC")
         .when(m5 == 3, "ACCIDENT").otherwise("SURRENDER").alias("claim_type"),
        # a status no check allows and, where the key is also a multiple of 5, none at all
        F.when(ok % 6 == 0, "LODGED").when(ok % 6 == 1, "ASSESSING").when(ok % 6 == 2, "APPROVED")
         .when(ok % 6 == 3, "REJECTED").when(ok % 6 == 4, "PAID").when(m5 > 0, "REOPENED").alias("claim_status"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("lodged_at"))
    return {"ops_policies": policies, "ops_claims": claims}


@register("x7_ops_constraint_checks", suite_sql(OPS_SUITE))
def x7(spark, sf):
    return run_tests(ops_tables(spark, sf), OPS_SUITE)


# --------------------------------------------------------------- quarantine
RUN_A = "2024-01-20 00:00:00"
RUN_B = "2024-01-31 00:00:00"
NOW = "2024-01-31 00:30:00"
_ERR_COLS = ", ".join(c for c, _ in Q.ERROR_COLUMNS)
_KEY_EQ = ("a.pipe_name = b.pipe_name AND coalesce(a.file_name, '') = coalesce(b.file_name, '') "
           "AND coalesce(a.row_number, -1) = coalesce(b.row_number, -1) AND coalesce(a.line, -1) = coalesce(b.line, -1)")
_DEDUP_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c, _ in Q.ERROR_COLUMNS)


def _dedup_sql(where: str) -> str:
    return (f"SELECT {_ERR_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY pipe_name, coalesce(file_name, ''), "
            f"coalesce(row_number, -1), coalesce(line, -1) ORDER BY {_DEDUP_ORDER}) AS rn "
            f"FROM fx_pipe_errors WHERE {where}) WHERE rn = 1")


cte("q_run_a", f"SELECT *, TIMESTAMP '{RUN_A}' AS captured_at FROM ({_dedup_sql(f'error_ts < TIMESTAMP {chr(39)}{RUN_A}{chr(39)}')})")
cte("q_run_b", f"""SELECT b.*, TIMESTAMP '{RUN_B}' AS captured_at
FROM ({_dedup_sql("error_ts >= TIMESTAMP '2024-01-19 00:00:00'")}) b
WHERE NOT EXISTS (SELECT 1 FROM q_run_a a WHERE {_KEY_EQ})""")
cte("quarantine_table", "SELECT * FROM q_run_a UNION ALL SELECT * FROM q_run_b")


def quarantine_table(spark, sf):
    """Two capture runs: the first over errors before RUN_A, the second over
    an overlapping later window (re-seen errors are not inserted again)."""
    errors = fixtures.pipe_errors(TableSource(spark, sf))
    first = Q.capture(errors.where(F.col("error_ts") < F.lit(RUN_A).cast("timestamp_ntz")), None,
                      F.lit(RUN_A).cast("timestamp_ntz"))
    second = Q.capture(errors.where(F.col("error_ts") >= F.lit("2024-01-19 00:00:00").cast("timestamp_ntz")),
                       first, F.lit(RUN_B).cast("timestamp_ntz"))
    return first.unionByName(second)


register("q1_quarantine_capture", "SELECT * FROM quarantine_table")(quarantine_table)


@register("q2_latest_failures", """
SELECT pipe_name, file_name, error, captured_at FROM quarantine_table
ORDER BY captured_at DESC, pipe_name, file_name ASC NULLS LAST, error ASC NULLS LAST LIMIT 100""")
def q2(spark, sf):
    return Q.latest_failures(quarantine_table(spark, sf))


@register("q3_errors_per_pipe_24h", f"""
SELECT pipe_name, count(*) AS errors FROM quarantine_table
WHERE captured_at > TIMESTAMP '{NOW}' - INTERVAL 24 HOUR GROUP BY pipe_name ORDER BY errors DESC, pipe_name""")
def q3(spark, sf):
    return Q.errors_per_pipe(quarantine_table(spark, sf), NOW)


@register("q4_alert_predicate", f"""
SELECT count(*) > 0 AS alert FROM (SELECT 1 FROM quarantine_table
WHERE captured_at > TIMESTAMP '{NOW}' - INTERVAL 60 MINUTE LIMIT 1)""")
def q4(spark, sf):
    return Q.alert(quarantine_table(spark, sf), NOW)


# --------------------------------------------------------------- one query per test kind
def _kind_suite(kind):
    tests = [t for t in CORE_SUITE if t.kind == kind]

    def run(spark, sf):
        return run_tests(core_tables(wh(spark, sf), tests), tests)
    return tests, run


for _id, _kind in (("x1", "not_null"), ("x2", "unique"), ("x3", "accepted_values"),
                   ("x4", "relationships"), ("x5", "unique_combination_of_columns")):
    _tests, _run = _kind_suite(_kind)
    register(f"{_id}_{_kind}_checks", suite_sql(_tests))(_run)
