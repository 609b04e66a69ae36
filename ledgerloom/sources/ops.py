"""Operational source tables (S7): replication of ``policies_master`` and
``claims`` by high-water mark with soft deletes.

Replication (S7): a full refresh, then increments of rows whose
``updated_at`` is not below the target's high-water mark (rows sharing the
mark's time are not lost; the upsert makes repeats harmless).  The mark is one
scalar read from the target (it has to become a predicate of the source
query, e.g. a JDBC ``WHERE``).  The upsert keeps the latest row per primary
key with a ``max_by`` aggregate; ``is_deleted`` rows are kept in the
replica and filtered from the current view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import stage
from .tables import TableSource

# --- fixed values: enumerations of the operational schema ------------------
PRODUCT_CODES = ["LIFE_001", "LIFE_002", "DIS_001", "CHR_001", "ACC_001", "INV_001"]
CLAIM_TYPES = ["DEATH", "DISABILITY", "CHRONIC", "ACCIDENT", "SURRENDER"]
CLAIM_STATUSES = ["LODGED", "ASSESSING", "APPROVED", "REJECTED", "PAID"]

FULL_REFRESH_TS = "2024-01-01 00:00:00"


def jdbc_source(spark: SparkSession, url: str, table: str, props: dict | None = None,
                high_water=None, cursor: str = "updated_at", split: str | None = None,
                bounds: tuple[int, int] | None = None, partitions: int = 1) -> DataFrame:
    """Read an operational table over JDBC, in ``partitions`` ranges of the
    integer column ``split`` between ``bounds``; with a high-water mark only
    rows changed since it are fetched (Spark pushes the filter down)."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(props or {}))
    if split and bounds:
        reader = reader.options(partitionColumn=split, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
                                numPartitions=str(partitions))
    rows = reader.load()
    return rows if high_water is None else rows.where(F.col(cursor) >= F.lit(high_water))


def high_water_mark(target: DataFrame, cursor: str = "updated_at"):
    """Largest cursor value already replicated (one scalar)."""
    row = target.agg(F.max(cursor).alias("hw")).first()
    return row["hw"] if row else None


def upsert_latest(target: DataFrame | None, increment: DataFrame, pk: str,
                  cursor: str = "updated_at") -> DataFrame:
    """Replica after applying ``increment``: latest row per key by cursor
    (ties broken by the full row so reruns are stable)."""
    rows = increment if target is None else target.unionByName(increment)
    payload = F.struct(*[F.col(c) for c in rows.columns])
    rank = F.struct(F.col(cursor), payload)
    return rows.groupBy(pk).agg(F.max_by(payload, rank).alias("r")).select("r.*")


def current_view(replica: DataFrame) -> DataFrame:
    """Soft-deleted rows are hidden from consumers."""
    return replica.where(~F.col("is_deleted"))


# ------------------------------------------------------------------ derived ops tables
def ops_policies(tables: TableSource, version: int = 0) -> DataFrame:
    """``policies_master`` derived from ``customer``.  Version 1 is the
    source after a day of changes: ``c_custkey % 10 = 1`` lapse,
    ``c_custkey % 25 = 2`` are soft-deleted."""
    c = tables("customer")
    k = F.col("c_custkey")
    m4 = k % 4
    base_ts = F.lit(FULL_REFRESH_TS).cast("timestamp_ntz")
    df = c.select(
        (k + 1).alias("policy_id"),
        F.concat(F.lit("POL-"), F.lpad((k + 1).cast("string"), 8, "0")).alias("policy_number"),
        F.lpad((F.lit(1000000000) + (k * 7919) % 8999999999).cast("string"), 13, "0").alias("client_id_number"),
        F.element_at(F.array(*[F.lit(p) for p in PRODUCT_CODES]), (k % 6 + 1).cast("int")).alias("product_code"),
        F.date_add(F.lit("2018-01-01").cast("date"), (k % 2900).cast("int")).alias("inception_date"),
        F.when(m4 == 1, "LAPSED").when(m4 == 2, "PAID_UP").otherwise("ACTIVE").alias("status"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("monthly_premium"),
        F.concat(F.lit("ADV-"), F.lpad((k % 200 + 1).cast("string"), 4, "0")).alias("advisor_identifier"),
        base_ts.alias("created_at"), base_ts.alias("updated_at"),
        F.lit(False).alias("is_deleted"))
    if version == 0:
        return df
    k1 = F.col("policy_id") - 1
    lapse, delete = (k1 % 10 == 1), (k1 % 25 == 2)
    return (df.where(lapse | delete)
            .withColumn("status", F.when(lapse, F.lit("LAPSED")).otherwise(F.col("status")))
            .withColumn("is_deleted", delete)
            .withColumn("updated_at", F.when(delete, F.lit("2024-02-02 09:00:00").cast("timestamp_ntz"))
                        .otherwise(F.lit("2024-02-01 10:00:00").cast("timestamp_ntz"))))


def ops_claims(tables: TableSource, version: int = 0) -> DataFrame:
    """``claims`` derived from ``orders``.  Version 1 is the source after a
    day of changes: ``o_orderkey % 10 = 1`` are paid, ``o_orderkey % 25 = 2``
    are soft-deleted."""
    k, base_ts = F.col("o_orderkey"), F.lit(FULL_REFRESH_TS).cast("timestamp_ntz")
    df = tables("orders").select(
        (k + 1).alias("claim_id"),
        F.concat(F.lit("CLM-"), F.lpad((k + 1).cast("string"), 9, "0")).alias("claim_reference"),
        (F.col("o_custkey") + 1).alias("policy_id"),
        F.element_at(F.array(*[F.lit(t) for t in CLAIM_TYPES]), (k % 5 + 1).cast("int")).alias("claim_type"),
        F.element_at(F.array(*[F.lit(t) for t in CLAIM_STATUSES[:4]]), (k % 4 + 1).cast("int")).alias("claim_status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("claim_amount"),
        F.lit(None).cast("decimal(18,2)").alias("paid_amount"),
        base_ts.alias("updated_at"), F.lit(False).alias("is_deleted"))
    if version == 0:
        return df
    k1 = F.col("claim_id") - 1
    paid, delete = (k1 % 10 == 1), (k1 % 25 == 2)
    return df.where(paid | delete).withColumns({
        "claim_status": F.when(paid, F.lit("PAID")).otherwise(F.col("claim_status")),
        "paid_amount": F.when(paid, F.col("claim_amount")),
        "is_deleted": delete,
        "updated_at": F.lit("2024-02-01 10:00:00").cast("timestamp_ntz")})


def replicate_claims(tables: TableSource) -> DataFrame:
    """As ``replicate_policies``, for the claims."""
    return _replicated(lambda version: ops_claims(tables, version), "claim_id")


def replicate_policies(tables: TableSource) -> DataFrame:
    """Full refresh, then one incremental sync above the high-water mark;
    returns the current (not deleted) view."""
    return _replicated(lambda version: ops_policies(tables, version), "policy_id")


def _replicated(source, pk: str) -> DataFrame:
    replica = stage(upsert_latest(None, source(0), pk), f"ops-{pk}")
    mark = high_water_mark(replica)
    increment = source(1)
    if mark is not None:
        increment = increment.where(F.col("updated_at") >= F.lit(mark).cast("timestamp_ntz"))
    return current_view(upsert_latest(replica, increment, pk))
