"""Vault and SCD-2 in DuckDB SQL (twin of operators/vault.py, operators/scd.py)."""

from __future__ import annotations

from . import warehouse_sql as W
from .cte import cte

RUN1 = W.RUN_TS
RUN2 = W.RUN2_TS
SAT_DETAILS = ["transaction_type", "transaction_date", "status", "reference_number", "narrative",
               "claim_type", "claim_reason", "benefit_affected", "transaction_category"]
SAT_AMOUNTS = ["amount", "units", "price_per_unit"]
CHECK = ["policy_status", "product_name", "member_id", "income_bracket", "smoker_status", "age_next",
         "life_sum_assured", "life_premium", "disability_type", "disability_sum_assured", "disability_premium",
         "chronic_level", "chronic_waiting_period", "chronic_premium", "accident_benefit", "accident_premium",
         "total_monthly_premium", "commission_rate"]


def hub_sql(hk: str, keys: list[str], src: str, run_ts: str) -> str:
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys if k != "company")
    return (f"SELECT {W.sk(*keys)} AS {hk}, {', '.join(keys)}, {run_ts} AS load_dts, "
            f"'fct_transactions' AS record_source "
            f"FROM (SELECT DISTINCT {', '.join(keys)} FROM {src} WHERE {nn})")


def link_sql(hk: str, keys: list[str], hubs: list[tuple[str, list[str]]], src: str, run_ts: str) -> str:
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys if k != "company")
    hub_cols = ", ".join(f"{W.sk(*k)} AS {n}" for n, k in hubs)
    return (f"SELECT {W.sk(*keys)} AS {hk}, {hub_cols}, {run_ts} AS load_dts, 'fct_transactions' AS record_source "
            f"FROM (SELECT DISTINCT {', '.join(keys)} FROM {src} WHERE {nn})")


def sat_source_sql(cols: list[str], src: str, run_ts: str, collapse: bool = False) -> str:
    base = src
    if collapse:
        base = (f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company, transaction_id "
                f"ORDER BY _row_in_grain DESC) AS rn_c FROM {src} WHERE transaction_id IS NOT NULL) WHERE rn_c = 1)")
    return (f"SELECT {W.sk('company', 'transaction_id')} AS transaction_hk, {', '.join(cols)}, {run_ts} AS load_dts, "
            f"'fct_transactions' AS record_source, {W.hashdiff(*cols)} AS hashdiff "
            f"FROM {base} WHERE transaction_id IS NOT NULL")


def sat_run2_sql(run1: str, src2: str) -> str:
    return f"""
SELECT * FROM {run1}
UNION ALL
SELECT s.* FROM {src2} s
LEFT JOIN (SELECT transaction_hk, hashdiff AS latest_hashdiff FROM (
             SELECT transaction_hk, hashdiff, row_number() OVER (PARTITION BY transaction_hk
               ORDER BY load_dts DESC, hashdiff DESC) AS rn FROM {run1}) WHERE rn = 1) l
  ON s.transaction_hk = l.transaction_hk
WHERE l.latest_hashdiff IS NULL OR l.latest_hashdiff <> s.hashdiff"""


for name, cols in (("sat_details", SAT_DETAILS), ("sat_amounts", SAT_AMOUNTS)):
    cte(f"{name}_run1", sat_source_sql(cols, "fct_transactions", RUN1))
    cte(f"{name}_src2", sat_source_sql(cols, "fct_transactions_v1", RUN2))
    cte(f"{name}_run2", sat_run2_sql(f"{name}_run1", f"{name}_src2"))
    cte(f"{name}_fixed_run1", sat_source_sql(cols, "fct_transactions", RUN1, collapse=True))
    cte(f"{name}_fixed_src2", sat_source_sql(cols, "fct_transactions_v1", RUN2, collapse=True))
    cte(f"{name}_fixed_run2", sat_run2_sql(f"{name}_fixed_run1", f"{name}_fixed_src2"))


def scd_id(ts: str) -> str:
    return f"md5(concat_ws('|', coalesce(CAST(policy_sk AS VARCHAR), ''), coalesce(CAST({ts} AS VARCHAR), '')))"


cte("snp_run1", f"""
SELECT *, {scd_id(RUN1)} AS dbt_scd_id, {RUN1} AS dbt_updated_at, {RUN1} AS dbt_valid_from,
  CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM dim_policy""")
_changed = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in CHECK)
cte("snp_changed", f"""
SELECT o.policy_sk FROM snp_run1 o JOIN dim_policy_v1 n ON o.policy_sk = n.policy_sk
WHERE o.dbt_valid_to IS NULL AND ({_changed})""")
cte("snp_run2", f"""
SELECT * FROM snp_run1 WHERE dbt_valid_to IS NOT NULL
UNION ALL BY NAME
SELECT * REPLACE ({RUN2} AS dbt_valid_to) FROM snp_run1
WHERE dbt_valid_to IS NULL AND policy_sk IN (SELECT policy_sk FROM snp_changed)
UNION ALL BY NAME
SELECT * FROM snp_run1 WHERE dbt_valid_to IS NULL AND policy_sk NOT IN (SELECT policy_sk FROM snp_changed)
UNION ALL BY NAME
SELECT *, {scd_id(RUN2)} AS dbt_scd_id, {RUN2} AS dbt_updated_at, {RUN2} AS dbt_valid_from,
  CAST(NULL AS TIMESTAMP) AS dbt_valid_to
FROM dim_policy_v1
WHERE policy_sk IN (SELECT policy_sk FROM snp_changed)
   OR policy_sk NOT IN (SELECT policy_sk FROM snp_run1 WHERE dbt_valid_to IS NULL)""")

_HIST = ", ".join(["policy_sk", "company", "policy_number", "policy_universe", "inception_date", "policy_status",
                   "member_id", "age_next", "smoker_status", "income_bracket", "product_name", "life_sum_assured",
                   "life_premium", "disability_type", "disability_sum_assured", "disability_premium",
                   "chronic_level", "chronic_waiting_period", "chronic_premium", "accident_benefit",
                   "accident_premium", "total_monthly_premium", "commission_rate"])
cte("policy_history", f"""
SELECT {_HIST}, dbt_valid_from AS valid_from,
  coalesce(dbt_valid_to, TIMESTAMP '9999-12-31 00:00:00') AS valid_to, dbt_valid_to IS NULL AS is_current,
  dbt_scd_id AS policy_version_id, dbt_updated_at AS version_recorded_at, _loaded_at
FROM snp_run2""")
