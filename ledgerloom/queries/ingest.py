"""Registered queries: landing ingest (S1-S6), ops replication (S7) and the
table store (S9).

The CSV drops are derived from the driver's tables by Spark (the fixture
rules written as CSV files into a fresh folder under the shared checkpoint
folder), then loaded by the real scan / route / split / write path."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..catalog import register
from ..session import shared_path
from ..sources import fixtures
from ..sources import landing as L
from ..sources import ops
from ..sources.tables import TableSource
from ..streaming.file_ingest import start_file_ingest

RUN_TS = "2024-06-30 00:00:00"
BAD_FILE = "fsp-main_book_risk_benefits_transactions_bad.csv"


def _fresh(spark, what: str) -> str:
    return shared_path(spark, "ingest", f"{what}-{uuid.uuid4().hex}")


def _drop(spark, sf, shapes, bad_lines: bool = False, copies: int = 1) -> str:
    t = TableSource(spark, sf)
    makers = {"commissions": lambda: fixtures.commissions(t),
              "risk_transactions": lambda: fixtures.risk_transactions(t),
              "risk_policies": lambda: fixtures.risk_policies(t),
              "valuations": lambda: fixtures.valuations(t),
              "investment_transactions": lambda: fixtures.investment_transactions(t)}
    drop = _fresh(spark, "drop")
    for shape in shapes:
        L.write_drop(makers[shape](), shape, drop, compression="gzip")
    if bad_lines:
        e = t("events").where(F.col("event_id") % 97 == 0)
        line = F.concat(F.lit("RT"), fixtures.pad(F.col("event_id"), 9), F.lit(',"'), F.col("event_type"))
        # one raw line per row: no quoting, one header line per part file
        bad = e.select(F.explode(F.array_repeat(line, copies)).alias("v"))
        (bad.write.mode("overwrite")
         .options(sep="\u0001", quote="\u0000", escapeQuotes="false", header="true")
         .csv(f"{drop}/_f={BAD_FILE}"))
    return drop


def _batch_landing(spark, sf, shapes, bad_lines=False, copies=1):
    drop = _drop(spark, sf, shapes, bad_lines, copies)
    base = _fresh(spark, "landing")
    L.ingest_batch(spark, drop, f"{base}/raw", f"{base}/quarantine", RUN_TS, "batch-0001", shapes)
    return base


_LAND = "SELECT * REPLACE (TIMESTAMP '2024-06-30 00:00:00' AS _loaded_at) FROM {fx}"


@register("s1_s2_s3_s6_landing_commissions", _LAND.format(fx="fx_commissions"))
def s1(spark, sf):
    base = _batch_landing(spark, sf, ["commissions"])
    return L.read_landing(spark, f"{base}/raw", "commissions")


@register("s3_landing_risk_policies", _LAND.format(fx="fx_risk_policies"))
def s3_policies(spark, sf):
    base = _batch_landing(spark, sf, ["risk_policies", "risk_transactions"])
    return L.read_landing(spark, f"{base}/raw", "risk_policies")


@register("s3_landing_risk_transactions", """
SELECT * EXCLUDE (_loaded_at), CASE WHEN company = 'MAIN_BOOK' THEN 'risk_benefits_transactions'
  ELSE 'ins_transactions' END AS dataset, TIMESTAMP '2024-06-30 00:00:00' AS _loaded_at
FROM fx_risk_transactions""")
def s3_txns(spark, sf):
    base = _batch_landing(spark, sf, ["risk_policies", "risk_transactions"])
    return L.read_landing(spark, f"{base}/raw", "risk_transactions")


@register("s6_landing_valuations", _LAND.format(fx="fx_valuations"))
def s6_valuations(spark, sf):
    return L.read_landing(spark, f"{_batch_landing(spark, sf, ['valuations'])}/raw", "valuations")


@register("s6_landing_investment_transactions", """
SELECT * EXCLUDE (_loaded_at), CASE WHEN company = 'MAIN_BOOK' THEN 'valuation_transactions' ELSE 'transactions' END
  AS dataset, TIMESTAMP '2024-06-30 00:00:00' AS _loaded_at FROM fx_investment_transactions""")
def s6_investment(spark, sf):
    base = _batch_landing(spark, sf, ["investment_transactions"])
    return L.read_landing(spark, f"{base}/raw", "investment_transactions")


@register("s5_rejected_rows_quarantined", f"""
SELECT 'PIPE_MAIN_BOOK_RISK_BENEFITS_TRANSACTIONS' AS pipe_name, '{BAD_FILE}' AS file_name,
  'RT' || (CASE WHEN length(CAST(event_id AS VARCHAR)) >= 9 THEN CAST(event_id AS VARCHAR)
           ELSE lpad(CAST(event_id AS VARCHAR), 9, '0') END) || ',"' || event_type AS rejected_record
FROM events WHERE event_id % 97 = 0""")
def s5(spark, sf):
    base = _batch_landing(spark, sf, ["risk_transactions"], bad_lines=True)
    q = L.read_quarantine(spark, f"{base}/raw", f"{base}/quarantine")
    return q.select("pipe_name", L.logical_file_name(F.col("file_name")).alias("file_name"), "rejected_record")


@register("s5_identical_bad_lines", """
SELECT 'RT' || (CASE WHEN length(CAST(event_id AS VARCHAR)) >= 9 THEN CAST(event_id AS VARCHAR)
                ELSE lpad(CAST(event_id AS VARCHAR), 9, '0') END) || ',"' || event_type AS rejected_record, 3 AS copies
FROM events WHERE event_id % 97 = 0""")
def s5_identical(spark, sf):
    """Each bad line stands three times in its file; the load is run twice."""
    drop = _drop(spark, sf, ["risk_transactions"], bad_lines=True, copies=3)
    base = _fresh(spark, "landing")
    for load in ("batch-0001", "batch-0002"):
        L.ingest_batch(spark, drop, f"{base}/raw", f"{base}/quarantine", RUN_TS, load, ["risk_transactions"])
    q = L.read_quarantine(spark, f"{base}/raw", f"{base}/quarantine")
    return q.groupBy("rejected_record").agg(F.count(F.lit(1)).cast("int").alias("copies"))


@register("s6_load_history", """
SELECT company, dataset, CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(bad) AS BIGINT) AS error_count,
  CASE WHEN sum(bad) > 0 THEN true ELSE false END AS any_partly_loaded
FROM (SELECT company, CASE WHEN company = 'MAIN_BOOK' THEN 'risk_benefits_transactions' ELSE 'ins_transactions' END AS dataset,
        1 AS n, 0 AS bad FROM fx_risk_transactions
      UNION ALL SELECT 'MAIN_BOOK', 'risk_benefits_transactions', 1, 1 FROM events WHERE event_id % 97 = 0)
GROUP BY company, dataset""")
def s6_history(spark, sf):
    """The load manifest: rows and rejected rows of every loaded file, summed by feed."""
    base = _batch_landing(spark, sf, ["risk_transactions"], bad_lines=True)
    files = L.load_history(spark, f"{base}/raw")
    return files.groupBy("company", "dataset").agg(
        F.sum("row_count").alias("row_count"), F.sum("error_count").alias("error_count"),
        F.bool_or(F.col("status") != "LOADED").alias("any_partly_loaded"))


@register("s1_upper_case_header", _LAND.format(fx="fx_commissions"))
def s1_upper(spark, sf):
    """Header lines are skipped by position, whatever their case."""
    drop, base = _fresh(spark, "drop"), _fresh(spark, "landing")
    L.write_drop(fixtures.commissions(TableSource(spark, sf)), "commissions", drop, upper_header=True)
    L.ingest_batch(spark, drop, f"{base}/raw", f"{base}/quarantine", RUN_TS, "batch-0001", ["commissions"])
    return L.read_landing(spark, f"{base}/raw", "commissions")


@register("s1_quoted_line_breaks", """
SELECT transaction_id, transaction_type, 'a "b",' || chr(10) || transaction_id AS narrative, company FROM fx_risk_transactions""")
def s1_breaks(spark, sf):
    """Line breaks inside quoted fields, with the reader option for them."""
    drop, base = _fresh(spark, "drop"), _fresh(spark, "landing")
    rows = fixtures.risk_transactions(TableSource(spark, sf)).withColumn(
        "narrative", F.concat(F.lit('a "b",\n'), F.col("transaction_id")))
    L.write_drop(rows, "risk_transactions", drop)
    L.ingest_batch(spark, drop, f"{base}/raw", f"{base}/quarantine", RUN_TS, "batch-0001", ["risk_transactions"],
                   multi_line=True)
    return L.read_landing(spark, f"{base}/raw", "risk_transactions").select(
        "transaction_id", "transaction_type", "narrative", "company")


@register("s4_two_streams_one_landing", _LAND.format(fx="fx_commissions"))
def s4_two(spark, sf):
    """Two streams, each with its own checkpoint, into one landing root."""
    rows, base = fixtures.commissions(TableSource(spark, sf)), _fresh(spark, "stream")
    for name, part in (("a", F.col("company") == "MAIN_BOOK"), ("b", F.col("company") != "MAIN_BOOK")):
        drop = _fresh(spark, "drop")
        L.write_drop(rows.where(part), "commissions", drop)
        start_file_ingest(spark, drop, f"{base}/raw", f"{base}/quarantine", f"{base}/_checkpoint_{name}",
                          run_ts=RUN_TS).awaitTermination()
    return L.read_landing(spark, f"{base}/raw", "commissions")


@register("s5_good_rows_kept", _LAND.format(fx="fx_risk_transactions"))
def s5_good(spark, sf):
    base = _batch_landing(spark, sf, ["risk_transactions"], bad_lines=True)
    return L.read_landing(spark, f"{base}/raw", "risk_transactions").drop("dataset")


@register("s4_stream_ingest_commissions", _LAND.format(fx="fx_commissions"))
def s4(spark, sf):
    """AvailableNow stream over the drop; a second start finds nothing new."""
    drop = _drop(spark, sf, ["commissions"])
    base = _fresh(spark, "stream")
    for _ in range(2):
        q = start_file_ingest(spark, drop, f"{base}/raw", f"{base}/quarantine", f"{base}/_checkpoint",
                              run_ts=RUN_TS)
        q.awaitTermination()
    return L.read_landing(spark, f"{base}/raw", "commissions")


@register("s7_ops_policies_replicated", """
SELECT policy_id, policy_number, client_id_number, product_code, inception_date, status, monthly_premium,
  advisor_identifier, created_at, updated_at, is_deleted
FROM (
  SELECT c_custkey + 1 AS policy_id, 'POL-' || lpad(CAST(c_custkey + 1 AS VARCHAR), 8, '0') AS policy_number,
    lpad(CAST(1000000000 + (c_custkey * 7919) % 8999999999 AS VARCHAR), 13, '0') AS client_id_number,
    ['LIFE_001', 'LIFE_002', 'DIS_001', 'CHR_001', 'ACC_001', 'INV_001'][CAST(c_custkey % 6 + 1 AS INTEGER)] AS product_code,
    CAST(DATE '2018-01-01' + CAST(c_custkey % 2900 AS INTEGER) AS DATE) AS inception_date,
    CASE WHEN c_custkey % 10 = 1 THEN 'LAPSED' WHEN c_custkey % 4 = 1 THEN 'LAPSED'
         WHEN c_custkey % 4 = 2 THEN 'PAID_UP' ELSE 'ACTIVE' END AS status,
    CAST(c_acctbal AS DECIMAL(18,2)) AS monthly_premium,
    'ADV-' || lpad(CAST(c_custkey % 200 + 1 AS VARCHAR), 4, '0') AS advisor_identifier,
    TIMESTAMP '2024-01-01 00:00:00' AS created_at,
    CASE WHEN c_custkey % 25 = 2 THEN TIMESTAMP '2024-02-02 09:00:00'
         WHEN c_custkey % 10 = 1 THEN TIMESTAMP '2024-02-01 10:00:00'
         ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at,
    c_custkey % 25 = 2 AS is_deleted
  FROM customer)
WHERE NOT is_deleted""")
def s7(spark, sf):
    return ops.replicate_policies(TableSource(spark, sf))


@register("s7_ops_claims_replicated", """
SELECT o_orderkey + 1 AS claim_id, 'CLM-' || lpad(CAST(o_orderkey + 1 AS VARCHAR), 9, '0') AS claim_reference,
  o_custkey + 1 AS policy_id,
  ['DEATH', 'DISABILITY', 'CHRONIC', 'ACCIDENT', 'SURRENDER'][CAST(o_orderkey % 5 + 1 AS INTEGER)] AS claim_type,
  CASE WHEN o_orderkey % 10 = 1 THEN 'PAID'
       ELSE ['LODGED', 'ASSESSING', 'APPROVED', 'REJECTED'][CAST(o_orderkey % 4 + 1 AS INTEGER)] END AS claim_status,
  CAST(o_totalprice AS DECIMAL(18,2)) AS claim_amount,
  CASE WHEN o_orderkey % 10 = 1 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS paid_amount,
  CASE WHEN o_orderkey % 10 = 1 THEN TIMESTAMP '2024-02-01 10:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at,
  false AS is_deleted
FROM orders WHERE o_orderkey % 25 <> 2""")
def s7_claims(spark, sf):
    return ops.replicate_claims(TableSource(spark, sf))


@register("s9_table_store_roundtrip", "SELECT * FROM mart_finance")
def s9(spark, sf):
    """Sink: the mart written as a run of the versioned table store, twice
    (a retried run), and read back as the latest run."""
    from ..plans.build import TableStore
    from ..plans.warehouse import Warehouse
    store = TableStore(spark, _fresh(spark, "store"))
    m1 = Warehouse.from_fixtures(spark, sf).finance_advisor_commissions_monthly
    for _ in range(2):
        store.write_run("finance_advisor_commissions_monthly", m1, "20240630T000000")
        store.publish("20240630T000000")
    return store.latest("finance_advisor_commissions_monthly")
