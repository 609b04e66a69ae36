"""Staging (T1-T6): typed, renamed projections of landing feeds.

One parametrised typing function per shape replaces the reference's 18
near-identical models; the tenant comes in as the ``company`` column (a
partition column of the landing layout), so the later "union of tenants" is
already done by the scan.  Casts are strict (ANSI): a bad value fails the
job.  ``safe=True`` uses ``try_cast`` instead and is meant to be paired with
quarantine routing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

PASSTHROUGH = ["company", "dataset"]


def _typed(df: DataFrame, columns, types: dict, safe: bool) -> DataFrame:
    out = [F.col(c) for c in PASSTHROUGH if c in df.columns]
    for c in columns:
        if c in types:
            col = F.col(c).try_cast(types[c]) if safe else F.col(c).cast(types[c])
            out.append(col.alias(c))
        else:
            out.append(F.col(c))
    out.append(F.col("_loaded_at"))
    return df.select(*out)


def stage_commissions(landing: DataFrame, safe: bool = False) -> DataFrame:
    """Insurance and investment commissions of every tenant."""
    return _typed(landing, S.COMMISSION_COLUMNS, S.COMMISSION_TYPES, safe)


def stage_valuations(landing: DataFrame, safe: bool = False) -> DataFrame:
    """T2."""
    return _typed(landing, S.VALUATION_COLUMNS, S.VALUATION_TYPES, safe)


def stage_investment_transactions(landing: DataFrame, safe: bool = False) -> DataFrame:
    """T3."""
    return _typed(landing, S.INVESTMENT_TXN_COLUMNS, S.INVESTMENT_TXN_TYPES, safe)


def stage_risk_transactions(landing: DataFrame, safe: bool = False) -> DataFrame:
    """T4."""
    return _typed(landing, S.RISK_TXN_COLUMNS, S.RISK_TXN_TYPES, safe)


def stage_risk_policies(landing: DataFrame, safe: bool = False) -> DataFrame:
    """PascalCase landing names -> snake_case, then typed.  A feed
    without ``productname`` (T5) gets a typed NULL ``product_name``."""
    df = landing
    if "productname" not in df.columns:
        df = df.withColumn("productname", F.lit(None).cast("string"))
    df = df.withColumnsRenamed(S.RISK_POLICY_RENAMES)
    typed_names = [S.RISK_POLICY_RENAMES.get(c, c) for c in S.RISK_POLICY_COLUMNS_WITH_PRODUCT]
    return _typed(df, typed_names, S.RISK_POLICY_TYPES, safe)
