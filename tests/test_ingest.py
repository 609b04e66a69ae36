"""CSV landing: format edge cases, routing, reject split, streaming exactly-once."""

import os

from pyspark.sql import functions as F

from ledgerloom.operators import quarantine as Q
from ledgerloom.sources import landing as L
from ledgerloom.streaming.file_ingest import start_file_ingest

HEADER = ",".join(["transaction_id", "policy_number", "member_id", "transaction_type", "transaction_date",
                   "amount", "status", "reference_number", "narrative", "claim_type", "claim_reason",
                   "benefit_affected", "client_title", "client_first_name", "client_surname", "client_initials"])


def _write(path, lines, raw=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(raw if raw is not None else ("\n".join(lines) + "\n").encode("utf-8"))


def test_format_edge_cases_and_routing(spark, tmp_path):
    drop = str(tmp_path / "drop")
    rows = [
        HEADER,
        'T1,P1,M1,claim,2024-01-02,10.50,POSTED,R1,"a, quoted comma",,,,,,,',
        'T2,NULL,null,\\N,2024-01-03,"",  padded  ,R2,"say ""hi""",,,,,,,',
        'T3,P3',                                             # short row: padded with NULL
        'T4,P4,M4,x,2024-01-04,1.00,S,R4,n,c,r,b,t,f,s,i,EXTRA,MORE',   # long row: truncated
        'T5,P5,M5,"unterminated,2024-01-05',                 # unbalanced quote: rejected
    ]
    _write(f"{drop}/fsp-main_book_risk_benefits_transactions_20240101.csv", rows)
    # a risk master file must not be taken by the transactions feed and vice versa
    _write(f"{drop}/fsp-main_book_risk_benefits.csv", ["policynumber,inceptiondate", "RB1,2015-01-01"])
    _write(f"{drop}/unrelated.csv", ["a,b", "1,2"])
    routed = L.read_routed(spark, drop).persist()
    assert {r.dataset for r in routed.select("dataset").distinct().collect()} == \
        {"risk_benefits_transactions", "risk_benefits"}
    good, bad = L.split(routed)
    land = {r.transaction_id: r for r in L.to_landing(good, "risk_transactions", "2024-06-30 00:00:00").collect()}
    assert set(land) == {"T1", "T2", "T3", "T4"}
    assert land["T1"].narrative == "a, quoted comma"
    assert land["T2"].policy_number is None and land["T2"].member_id is None
    assert land["T2"].transaction_type is None and land["T2"].amount is None
    assert land["T2"].status == "padded" and land["T2"].narrative == 'say "hi"'
    assert land["T3"].member_id is None and land["T3"].client_initials is None
    assert land["T4"].client_initials == "i"
    rej = bad.collect()
    assert len(rej) == 1 and rej[0]._corrupt_record.startswith("T5")
    master = L.to_landing(good, "risk_policies", "2024-06-30 00:00:00").collect()
    assert [(r.policynumber, r.productname) for r in master] == [("RB1", None)]


def test_invalid_utf8_is_replaced(spark, tmp_path):
    drop = str(tmp_path / "drop")
    raw = (HEADER + "\n").encode() + b"T9,P\xff9,M9\n"
    _write(f"{drop}/fsp-indigo_ins_transactions.csv", [], raw=raw)
    good, _ = L.split(L.read_routed(spark, drop))
    row = L.to_landing(good, "risk_transactions", "2024-06-30 00:00:00").collect()[0]
    assert row.policy_number == "P�9" and row.company == "INDIGO_INSURANCE"


def test_batch_ingest_quarantine_is_idempotent(spark, tmp_path):
    drop = str(tmp_path / "drop")
    _write(f"{drop}/fsp-horizon_ins_transactions.csv", [HEADER, 'T1,"bad', "T2,P2"])
    root, qpath = str(tmp_path / "raw"), str(tmp_path / "q")
    for load in ("l1", "l1", "l2"):                         # retried load + a later one
        L.ingest_batch(spark, drop, root, qpath, "2024-06-30 00:00:00", load, ["risk_transactions"])
    q = spark.read.parquet(qpath)
    assert q.count() == 1 and q.first().pipe_name == "PIPE_HORIZON_ASSURANCE_INS_TRANSACTIONS"
    assert L.read_landing(spark, root, "risk_transactions").count() == 2   # l1 (overwritten) + l2


def test_a_load_that_dies_half_way_shows_nothing(spark, tmp_path, monkeypatch):
    drop, root, qpath = str(tmp_path / "drop"), str(tmp_path / "raw"), str(tmp_path / "q")
    _write(f"{drop}/fsp-horizon_ins_transactions.csv", [HEADER, 'T1,"bad', "T2,P2"])
    _write(f"{drop}/fsp-main_book_ins_commissions_1.csv", ["commission_id,policy_number", "C1,P1"])
    writes, real = [], L.write_landing

    def third_fails(*args):
        writes.append(args[2])
        if len(writes) == 3:
            raise OSError("lost")
        real(*args)
    monkeypatch.setattr(L, "write_landing", third_fails)
    try:
        L.ingest_batch(spark, drop, root, qpath, "2024-06-30 00:00:00", "l1")
    except OSError:
        pass
    assert len(writes) == 3 and L.committed_loads(spark, root) == []
    assert all(L.read_landing(spark, root, shape).count() == 0 for shape in L.SHAPES)
    assert L.read_quarantine(spark, root, qpath) is None and L.load_history(spark, root) is None
    L.ingest_batch(spark, drop, root, qpath, "2024-06-30 00:00:00", "l1")      # the retry
    assert L.read_landing(spark, root, "commissions").count() == 1
    assert L.read_landing(spark, root, "risk_transactions").count() == 1
    assert L.read_quarantine(spark, root, qpath).count() == 1
    state = {r.dataset: (r.row_count, r.error_count, r.status) for r in L.load_history(spark, root).collect()}
    assert state == {"ins_transactions": (2, 1, "PARTIALLY_LOADED"), "ins_commissions": (1, 0, "LOADED")}


def test_stream_loads_each_file_once(spark, tmp_path):
    drop, base = str(tmp_path / "drop"), str(tmp_path / "out")
    _write(f"{drop}/fsp-main_book_ins_commissions_1.csv",
           ["commission_id,policy_number", "C1,P1", "C2,P2"])

    def run():
        start_file_ingest(spark, drop, f"{base}/raw", f"{base}/q", f"{base}/ckpt",
                          run_ts="2024-06-30 00:00:00").awaitTermination()
        return L.read_landing(spark, f"{base}/raw", "commissions")

    assert run().count() == 2
    assert run().count() == 2                                  # rerun: nothing new
    _write(f"{drop}/fsp-main_book_ins_commissions_2.csv", ["commission_id,policy_number", "C3,P3"])
    out = run()
    assert sorted(r.commission_id for r in out.collect()) == ["C1", "C2", "C3"]


def test_quarantine_merge_key_is_null_safe(spark):
    cols = ", ".join(f"{c} {t}" for c, t in Q.ERROR_COLUMNS)
    e = spark.createDataFrame([("p", "err", None, None, None, None, None, None, None, None, None, None, "r")], cols)
    first = Q.capture(e, None, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).checkpoint(eager=True)
    again = Q.capture(e, first, F.lit("2024-01-01 00:05:00").cast("timestamp_ntz"))
    assert first.count() == 1 and again.count() == 0


def test_a_compressed_drop_lands_the_same_rows(spark, tmp_path):
    import glob
    from ledgerloom.queries.ingest import _drop
    from ledgerloom.schemas import FEEDS
    names = max((f.columns for f in FEEDS if f.shape == "risk_transactions"), key=len)
    rows = spark.range(500).select(
        F.when(F.col("id") % 2 == 0, "INDIGO_INSURANCE").otherwise("HORIZON_ASSURANCE").alias("company"),
        F.lit("ins_transactions").alias("dataset"),
        *[F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit('a "b", '), F.col("id").cast("string"))).alias(c) for c in names])
    landed = {}
    for kind in ("none", "gzip"):
        drop, root = str(tmp_path / kind / "drop"), str(tmp_path / kind / "raw")
        L.write_drop(rows, "risk_transactions", drop, compression=kind)
        _write(f"{drop}/_f=fsp-horizon_ins_transactions.csv/part-bad.csv", [HEADER, 'T1,"bad'])
        L.ingest_batch(spark, drop, root, str(tmp_path / kind / "q"), "2024-06-30 00:00:00", "b1", ["risk_transactions"])
        landed[kind] = sorted(map(str, L.read_landing(spark, root, "risk_transactions").collect()))
        assert [r.row_number for r in L.read_quarantine(spark, root, str(tmp_path / kind / "q")).collect()] == [2]
    assert len(landed["none"]) == 500 and landed["gzip"] == landed["none"]
    size = lambda kind: sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/{kind}/drop/*/part-0*"))
    assert size("gzip") < size("none") / 2
    assert spark.range(1).select(L.logical_file_name(F.lit("/d/fsp-x.csv.gz"))).first()[0] == "fsp-x.csv"
    files = glob.glob(f"{_drop(spark, '/root/testdata/sf0.001', ['valuations']).removeprefix('file:')}/*/part-*")
    assert files and all(f.endswith(".csv.gz") for f in files)
