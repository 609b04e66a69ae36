"""Staging casts are strict (ANSI); the safe variant yields NULL instead."""

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.operators import staging


def _landing(spark, amount):
    row = {c: None for c in S.RISK_TXN_COLUMNS}
    row.update(transaction_id="T1", transaction_date="2024-01-02", amount=amount)
    cols = ", ".join(f"{c} string" for c in ["company", "dataset"] + S.RISK_TXN_COLUMNS)
    df = spark.createDataFrame([tuple(["MAIN_BOOK", "risk_benefits_transactions"] +
                                      [row[c] for c in S.RISK_TXN_COLUMNS])], cols)
    return df.withColumn("_loaded_at", F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))


def test_strict_and_safe_typing(spark):
    good = staging.stage_risk_transactions(_landing(spark, "12.50")).first()
    assert str(good.amount) == "12.50" and str(good.transaction_date) == "2024-01-02"
    with pytest.raises(Exception):
        staging.stage_risk_transactions(_landing(spark, "12,5O")).collect()
    safe = staging.stage_risk_transactions(_landing(spark, "12,5O"), safe=True).first()
    assert safe.amount is None and safe.transaction_id == "T1"


def test_main_book_master_gets_typed_null_product(spark):
    cols = ", ".join(f"{c} string" for c in ["company", "dataset"] + S.RISK_POLICY_COLUMNS)
    vals = ["MAIN_BOOK", "risk_benefits"] + ["RB1", "2015-01-01", "Active", "M", "40"] + \
        [None] * (len(S.RISK_POLICY_COLUMNS) - 5)
    df = spark.createDataFrame([tuple(vals)], cols).withColumn("_loaded_at", F.lit(None).cast("timestamp_ntz"))
    out = staging.stage_risk_policies(df)
    assert dict(out.dtypes)["product_name"] == "string" and dict(out.dtypes)["age_next"] == "int"
    r = out.first()
    assert r.policy_number == "RB1" and r.age_next == 40 and r.product_name is None
