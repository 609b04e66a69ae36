"""Fixture and staging rules in DuckDB SQL (twin of sources/fixtures.py and
operators/staging.py)."""

from __future__ import annotations

from .cte import cte


def pad(x: str, n: int) -> str:
    s = f"CAST({x} AS VARCHAR)"
    return f"(CASE WHEN length({s}) >= {n} THEN {s} ELSE lpad({s}, {n}, '0') END)"


def tenant(k: str) -> str:
    return (f"(CASE ({k}) % 3 WHEN 0 THEN 'MAIN_BOOK' WHEN 1 THEN 'INDIGO_INSURANCE' "
            f"ELSE 'HORIZON_ASSURANCE' END)")


def shift20(ts: str) -> str:
    return f"CAST(CAST({ts} AS DATE) + INTERVAL 240 MONTH AS DATE)"


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def scaled(m: str, factor: str) -> str:
    return f"CAST({m} * CAST({factor} AS DECIMAL(8,4)) AS DECIMAL(18,2))"


def txt(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def client_id(c: str) -> str:
    return (f"((CASE WHEN {c} % 17 = 0 THEN 'X' ELSE '' END) || {pad(f'{c} % 100', 2)} || "
            f"{pad(f'1 + {c} % 12', 2)} || {pad(f'1 + {c} % 31', 2)} || {pad(c, 7)})")


def client_cols(c: str) -> str:
    return (f"CASE {c} % 4 WHEN 0 THEN 'Mr' WHEN 1 THEN 'Ms' WHEN 2 THEN 'Dr' END AS client_title, "
            f"CASE WHEN {c} % 10 = 9 THEN NULL ELSE 'Client' || CAST({c} % 97 AS VARCHAR) END AS client_first_name, "
            f"'Surname' || {pad(c, 7)} AS client_surname, "
            f"CASE WHEN {c} % 10 = 9 THEN NULL ELSE 'C' END AS client_initials")


LOAD_TS = "TIMESTAMP '2024-03-01 00:00:00'"

# ---------------------------------------------------------------- landing
cte("fx_commissions", f"""
SELECT {tenant('o_custkey')} AS company,
  CASE WHEN o_orderkey % 2 = 0 THEN 'ins_commissions' ELSE 'inv_commissions' END AS dataset,
  'COM' || {pad('o_orderkey', 9)} AS commission_id,
  CASE WHEN o_orderkey % 7 = 3 THEN NULL
       WHEN o_orderkey % 2 = 0 THEN 'RB' || {pad('o_custkey', 8)}
       ELSE 'INV' || {pad('o_custkey * 2 + 1', 8)} END AS policy_number,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'ADV' || {pad('o_custkey % 40', 4)} END AS advisor_identifier,
  substr(o_orderpriority, 3, 100) AS business_line,
  CASE WHEN o_orderstatus = 'F' THEN 'INITIAL' WHEN o_orderstatus = 'O' THEN 'RECURRING' ELSE 'CLAWBACK' END AS commission_type,
  {txt(shift20('o_orderdate'))} AS transaction_date,
  {txt(scaled(money('o_totalprice'), "'0.0500'"))} AS gross_amount,
  CAST(CAST({scaled(money('o_totalprice'), "'0.0500'")} - {scaled(money('o_totalprice'), "'0.0425'")} AS DECIMAL(18,2)) AS VARCHAR) AS vat_amount,
  {txt(scaled(money('o_totalprice'), "'0.0425'"))} AS net_amount,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'PC' || CAST(o_custkey % 4 AS VARCHAR) END AS product_code,
  '0.0500' AS commission_rate,
  CASE WHEN o_orderstatus = 'P' THEN 'LAPSE' END AS clawback_reason,
  'PAY' || {pad('o_orderkey', 9)} AS payment_reference,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {txt(shift20('o_orderdate'))} END AS payment_date,
  '1.0000' AS brokerage_split,
  CASE WHEN o_orderstatus = 'F' THEN 'PAID' ELSE 'PENDING' END AS status,
  CAST(NULL AS VARCHAR) AS client_title, CAST(NULL AS VARCHAR) AS client_first_name,
  CAST(NULL AS VARCHAR) AS client_surname, CAST(NULL AS VARCHAR) AS client_initials,
  {LOAD_TS} AS _loaded_at
FROM orders""")

cte("fx_lop", """
SELECT l.*, o.o_custkey, o.o_orderkey, p.p_name, p.p_type, p.p_size, p.p_retailprice
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""")

cte("fx_valuations", f"""
SELECT {tenant('o_custkey')} AS company, 'valuations' AS dataset,
  CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE 'ADV' || {pad('l_suppkey', 4)} END AS advisor_identifier,
  {client_cols('o_custkey')},
  {client_id('o_custkey')} AS client_id_number,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE 'INV' || {pad('o_custkey * 2 + o_orderkey % 2', 8)} END AS policy_number,
  CASE WHEN l_partkey % 5 = 3 THEN NULL ELSE 'Product ' || CAST(p_size % 4 AS VARCHAR) END AS product_name,
  CASE WHEN l_partkey % 6 = 1 THEN NULL ELSE 'PC' || CAST(p_size % 4 AS VARCHAR) END AS product_code,
  CASE WHEN l_partkey % 7 = 1 THEN NULL ELSE p_type END AS fund_name,
  CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 'FC' || CAST(p_size % 12 AS VARCHAR) END AS fund_code,
  CASE WHEN p_type < 'M' AND l_partkey % 5 <> 0 THEN 'J' || substr(p_type, 1, 3) END AS jse_code,
  CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE {txt(shift20('l_shipdate'))} END AS valuation_date,
  'ZAR' AS currency,
  {txt(money('l_extendedprice'))} AS market_value_amount,
  CAST(CAST(l_quantity AS DECIMAL(18,4)) AS VARCHAR) AS units,
  CAST(1 + o_orderkey % 12 AS VARCHAR) AS anniversary_month,
  CASE WHEN l_linenumber % 4 = 0 THEN {txt(scaled(money('l_extendedprice'), "'0.0040'"))} END AS monthly_income_amount,
  CASE WHEN l_linenumber % 4 = 0 THEN '0.0040' END AS monthly_income_pct,
  CASE WHEN l_linenumber % 4 = 0 THEN 'MONTHLY' END AS income_frequency,
  {LOAD_TS} AS _loaded_at
FROM fx_lop""")

cte("fx_investment_transactions", f"""
SELECT {tenant('o_custkey')} AS company,
  CASE WHEN l_orderkey % 12 = 0 THEN NULL
       ELSE 'IT' || {pad('l_orderkey', 9)} || '-' || CAST(l_linenumber AS VARCHAR) END AS transaction_id,
  'INV' || {pad('o_custkey * 2 + o_orderkey % 2', 8)} AS policy_number,
  {client_id('o_custkey')} AS client_id_number,
  CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 'FC' || CAST(p_size % 12 AS VARCHAR) END AS fund_code,
  l_returnflag AS transaction_type,
  {txt(shift20('l_shipdate'))} AS transaction_date,
  {txt(money('l_extendedprice'))} AS amount,
  CAST(CAST(l_quantity AS DECIMAL(18,4)) AS VARCHAR) AS units,
  CAST(CAST(p_retailprice AS DECIMAL(18,4)) AS VARCHAR) AS price_per_unit,
  CASE WHEN l_linestatus = 'F' THEN 'SETTLED' ELSE 'PENDING' END AS status,
  'REF' || {pad('l_orderkey', 9)} AS reference_number,
  CAST(NULL AS VARCHAR) AS source_fund,
  p_name AS narrative,
  {client_cols('o_custkey')},
  {LOAD_TS} AS _loaded_at
FROM fx_lop""")


def _risk_txn_sql(name: str, variant: int) -> None:
    status = "CASE WHEN event_type = 'error' THEN 'REVERSED' ELSE 'POSTED' END"
    if variant:
        status = f"CASE WHEN event_id % 100 = 0 THEN 'AMENDED' ELSE {status} END"
    cte(name, f"""
SELECT {tenant('user_id')} AS company,
  CASE WHEN event_id % 12 = 0 THEN NULL ELSE 'RT' || {pad('event_id', 9)} END AS transaction_id,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'RB' || {pad('user_id', 8)} END AS policy_number,
  'MEM' || {pad('user_id', 7)} AS member_id,
  event_type AS transaction_type,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS transaction_date,
  {txt(money('value'))} AS amount,
  {status} AS status,
  'RTR' || {pad('event_id', 9)} AS reference_number,
  props AS narrative,
  CASE WHEN event_type = 'purchase' THEN 'DEATH' END AS claim_type,
  CASE WHEN event_type = 'purchase' THEN 'NATURAL' END AS claim_reason,
  CASE WHEN event_type = 'purchase' THEN 'LIFE' END AS benefit_affected,
  CAST(NULL AS VARCHAR) AS client_title, CAST(NULL AS VARCHAR) AS client_first_name,
  CAST(NULL AS VARCHAR) AS client_surname, CAST(NULL AS VARCHAR) AS client_initials,
  {LOAD_TS} AS _loaded_at
FROM events""")


def _risk_policy_load(age_offset: int, loaded_at: str, where: str, variant: int) -> str:
    acct = money("c_acctbal")
    status = ("CASE c_custkey % 6 WHEN 0 THEN 'Active' WHEN 1 THEN 'Lapsed' WHEN 2 THEN 'Cancelled' "
              "WHEN 3 THEN 'Pending' WHEN 4 THEN NULL ELSE 'Active' END")
    if variant:
        status = f"CASE WHEN c_custkey % 50 = 0 THEN 'Lapsed' ELSE {status} END"
    return f"""
SELECT {tenant('c_custkey')} AS company,
  CASE c_custkey % 3 WHEN 0 THEN 'risk_benefits' WHEN 1 THEN 'insurance' ELSE 'assurance' END AS dataset,
  CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE 'RB' || {pad('c_custkey', 8)} END AS policynumber,
  CASE WHEN c_custkey % 12 = 5 THEN NULL
       ELSE CAST(CAST(DATE '2015-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS DATE) AS VARCHAR) END AS inceptiondate,
  {status} AS policystatus,
  'MEM' || {pad('c_custkey', 7)} AS memberid,
  CAST({age_offset} + 20 + c_custkey % 50 AS VARCHAR) AS agenext,
  CASE WHEN c_custkey % 5 = 0 THEN 'Smoker' WHEN c_custkey % 5 = 1 THEN NULL ELSE 'Non-Smoker' END AS smokerstatus,
  CASE WHEN c_custkey % 10 = 3 THEN NULL ELSE c_mktsegment END AS incomebrackets,
  CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 8 = 7 THEN NULL
       ELSE 'Cover ' || CAST(c_nationkey % 4 AS VARCHAR) END AS productname,
  {txt(scaled(acct, "'100'"))} AS life_sumassured,
  {txt(scaled(acct, "'0.0100'"))} AS life_premium,
  CASE WHEN c_custkey % 2 = 0 THEN 'FUNCTIONAL' ELSE 'OCCUPATIONAL' END AS disability_type,
  {txt(scaled(acct, "'50'"))} AS disability_sumassured,
  {txt(scaled(acct, "'0.0050'"))} AS disability_premium,
  CASE c_custkey % 3 WHEN 0 THEN 'LEVEL1' WHEN 1 THEN 'LEVEL2' END AS chronic_level,
  '3 months' AS chronic_waitingperiod,
  CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE {txt(scaled(acct, "'0.0020'"))} END AS chronic_premium,
  {txt(scaled(acct, "'10'"))} AS accident_benefit,
  {txt(scaled(acct, "'0.0010'"))} AS accident_premium,
  {txt(scaled(acct, "'0.0180'"))} AS total_monthlypremium,
  '0.0300' AS commission_rate,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'ADV' || {pad('c_custkey % 40', 4)} END AS advisor_identifier,
  CAST(NULL AS VARCHAR) AS client_title, CAST(NULL AS VARCHAR) AS client_first_name,
  c_name AS client_surname, CAST(NULL AS VARCHAR) AS client_initials,
  TIMESTAMP '{loaded_at}' AS _loaded_at
FROM customer {where}"""


def _risk_policies_sql(name: str, variant: int) -> None:
    cte(name, _risk_policy_load(0, "2024-01-01 00:00:00", "", variant)
        + "\nUNION ALL\n"
        + _risk_policy_load(1, "2024-02-01 00:00:00", "WHERE c_custkey % 10 = 0", variant))


_risk_txn_sql("fx_risk_transactions", 0)
_risk_txn_sql("fx_risk_transactions_changed", 1)
cte("fx_risk_transactions_v1", """
SELECT * FROM fx_risk_transactions_changed WHERE reference_number NOT LIKE '%77'
UNION ALL
SELECT * REPLACE ('RN' || substr(reference_number, 4) AS transaction_id, 'RX' || substr(member_id, 4) AS policy_number)
FROM fx_risk_transactions_changed WHERE reference_number LIKE '%25'""")
cte("fx_investment_transactions_v1", """
SELECT * FROM fx_investment_transactions WHERE reference_number NOT LIKE '%77'
UNION ALL
SELECT * REPLACE ('N' || transaction_id AS transaction_id, 'INX' || substr(policy_number, 4) AS policy_number,
  '9' || substr(client_id_number, 2) AS client_id_number, 'FN' || coalesce(substr(fund_code, 3), '0') AS fund_code)
FROM fx_investment_transactions WHERE reference_number LIKE '%25'""")
_risk_policies_sql("fx_risk_policies", 0)
_risk_policies_sql("fx_risk_policies_changed", 1)
cte("fx_risk_policies_v1", """
SELECT * FROM fx_risk_policies_changed WHERE memberid NOT LIKE '%47'
UNION ALL
SELECT * REPLACE ('RN' || substr(memberid, 4) AS policynumber) FROM fx_risk_policies_changed WHERE memberid LIKE '%31'""")

# ---------------------------------------------------------------- staging
_COMMISSION_TYPED = """
SELECT company, dataset, commission_id, policy_number, advisor_identifier, business_line, commission_type,
  CAST(transaction_date AS DATE) AS transaction_date, CAST(gross_amount AS DECIMAL(18,2)) AS gross_amount,
  CAST(vat_amount AS DECIMAL(18,2)) AS vat_amount, CAST(net_amount AS DECIMAL(18,2)) AS net_amount,
  product_code, CAST(commission_rate AS DECIMAL(8,4)) AS commission_rate, clawback_reason, payment_reference,
  CAST(payment_date AS DATE) AS payment_date, CAST(brokerage_split AS DECIMAL(8,4)) AS brokerage_split, status,
  client_title, client_first_name, client_surname, client_initials, _loaded_at
FROM fx_commissions"""
cte("stg_commissions", _COMMISSION_TYPED)

cte("stg_valuations", """
SELECT company, advisor_identifier, client_title, client_first_name, client_surname, client_initials,
  client_id_number, policy_number, product_name, product_code, fund_name, fund_code, jse_code,
  CAST(valuation_date AS DATE) AS valuation_date, currency,
  CAST(market_value_amount AS DECIMAL(18,2)) AS market_value_amount, CAST(units AS DECIMAL(18,4)) AS units,
  CAST(anniversary_month AS INTEGER) AS anniversary_month,
  CAST(monthly_income_amount AS DECIMAL(18,2)) AS monthly_income_amount,
  CAST(monthly_income_pct AS DECIMAL(8,4)) AS monthly_income_pct, income_frequency, _loaded_at
FROM fx_valuations""")

_INVESTMENT_TXN_TYPED = """
SELECT company, transaction_id, policy_number, client_id_number, fund_code, transaction_type,
  CAST(transaction_date AS DATE) AS transaction_date, CAST(amount AS DECIMAL(18,2)) AS amount,
  CAST(units AS DECIMAL(18,4)) AS units, CAST(price_per_unit AS DECIMAL(18,4)) AS price_per_unit,
  status, reference_number, source_fund, narrative, client_title, client_first_name, client_surname,
  client_initials, _loaded_at
FROM {src}"""
cte("stg_investment_transactions", _INVESTMENT_TXN_TYPED.format(src="fx_investment_transactions"))
cte("stg_investment_transactions_v1", _INVESTMENT_TXN_TYPED.format(src="fx_investment_transactions_v1"))

_RISK_TXN_TYPED = """
SELECT company, transaction_id, policy_number, member_id, transaction_type,
  CAST(transaction_date AS DATE) AS transaction_date, CAST(amount AS DECIMAL(18,2)) AS amount,
  status, reference_number, narrative, claim_type, claim_reason, benefit_affected,
  client_title, client_first_name, client_surname, client_initials, _loaded_at
FROM {src}"""
cte("stg_risk_transactions", _RISK_TXN_TYPED.format(src="fx_risk_transactions"))
cte("stg_risk_transactions_v1", _RISK_TXN_TYPED.format(src="fx_risk_transactions_v1"))

_RISK_POLICY_TYPED = """
SELECT company, policynumber AS policy_number, CAST(inceptiondate AS DATE) AS inception_date,
  policystatus AS policy_status, memberid AS member_id, CAST(agenext AS INTEGER) AS age_next,
  smokerstatus AS smoker_status, incomebrackets AS income_bracket, productname AS product_name,
  CAST(life_sumassured AS DECIMAL(18,2)) AS life_sum_assured, CAST(life_premium AS DECIMAL(18,2)) AS life_premium,
  disability_type, CAST(disability_sumassured AS DECIMAL(18,2)) AS disability_sum_assured,
  CAST(disability_premium AS DECIMAL(18,2)) AS disability_premium, chronic_level,
  chronic_waitingperiod AS chronic_waiting_period, CAST(chronic_premium AS DECIMAL(18,2)) AS chronic_premium,
  CAST(accident_benefit AS DECIMAL(18,2)) AS accident_benefit, CAST(accident_premium AS DECIMAL(18,2)) AS accident_premium,
  CAST(total_monthlypremium AS DECIMAL(18,2)) AS total_monthly_premium,
  CAST(commission_rate AS DECIMAL(8,4)) AS commission_rate, advisor_identifier,
  client_title, client_first_name, client_surname, client_initials, _loaded_at
FROM {src}"""
cte("stg_risk_policies", _RISK_POLICY_TYPED.format(src="fx_risk_policies"))
cte("stg_risk_policies_v1", _RISK_POLICY_TYPED.format(src="fx_risk_policies_v1"))

cte("fx_pipe_errors", f"""
SELECT 'PIPE_' || {tenant('user_id')} || '_RISK_TRANSACTIONS' AS pipe_name,
  'Numeric value ''' || props || ''' is not recognized' AS error,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'fsp-risk-' || strftime(ts, '%Y%m%d') || '.csv' END AS file_name,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 1000 + 2 END AS line,
  CAST(1 AS BIGINT) AS character_pos, CAST(NULL AS BIGINT) AS byte_offset, 'conversion' AS category,
  '100038' AS code, '22018' AS sql_state, '"AMOUNT"' AS column_name, event_id % 1000 + 1 AS row_number,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 1000 + 2 END AS row_start_line,
  props AS rejected_record, ts AS error_ts
FROM events WHERE event_type = 'error'""")
