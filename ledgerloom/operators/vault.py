"""Data Vault over the transactions fact (V1-V9).

Hubs and links are insert-only: candidate keys are DISTINCT-ed and hashed
once per key, then anti-joined against the hash column of the target (only
that one column is read from the target, so the scan is narrow).  The
reference's ``NOT IN`` becomes ``left_anti``: hash keys are never NULL, so
the null-aware semantics of NOT IN cannot differ and Spark avoids the
null-aware broadcast plan.

Satellites append a row when its hashdiff differs from the *latest* stored
version of the key (or the key is new).  "Latest" is the greatest
(load_dts, hashdiff) - partial aggregation, no window sort.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hashdiff, packed, surrogate_key, unpacked

RECORD_SOURCE = "fct_transactions"


@dataclass(frozen=True)
class Hub:
    name: str
    hk: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Link:
    name: str
    hk: str
    keys: tuple[str, ...]
    hubs: tuple[tuple[str, tuple[str, ...]], ...]


# --- fixed values: vault tables, hash-key names and business keys ----------
HUBS = {
    "hub_transaction": Hub("hub_transaction", "transaction_hk", ("company", "transaction_id")),
    "hub_policy": Hub("hub_policy", "policy_hk", ("company", "policy_number")),
    "hub_client": Hub("hub_client", "client_hk", ("company", "client_id_number")),
    "hub_fund": Hub("hub_fund", "fund_hk", ("company", "fund_code")),
}
LINKS = {
    "lnk_transaction_policy": Link(
        "lnk_transaction_policy", "transaction_policy_hk", ("company", "transaction_id", "policy_number"),
        (("transaction_hk", ("company", "transaction_id")), ("policy_hk", ("company", "policy_number")))),
    "lnk_transaction_client": Link(
        "lnk_transaction_client", "transaction_client_hk", ("company", "transaction_id", "client_id_number"),
        (("transaction_hk", ("company", "transaction_id")), ("client_hk", ("company", "client_id_number")))),
    "lnk_transaction_fund": Link(
        "lnk_transaction_fund", "transaction_fund_hk", ("company", "transaction_id", "fund_code"),
        (("transaction_hk", ("company", "transaction_id")), ("fund_hk", ("company", "fund_code")))),
}
SAT_DETAILS_COLUMNS = ["transaction_type", "transaction_date", "status", "reference_number", "narrative",
                       "claim_type", "claim_reason", "benefit_affected", "transaction_category"]
SAT_AMOUNTS_COLUMNS = ["amount", "units", "price_per_unit"]
SATELLITES = {"sat_transaction_details": SAT_DETAILS_COLUMNS,
              "sat_transaction_amounts": SAT_AMOUNTS_COLUMNS}


def _not_null(cols) -> F.Column:
    cond = None
    for c in cols:
        if c == "company":
            continue
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return cond


def hub_candidates(fct: DataFrame, hub: Hub, run_ts) -> DataFrame:
    keys = fct.where(_not_null(hub.keys)).select(*hub.keys).distinct()
    return keys.select(surrogate_key(*hub.keys).alias(hub.hk), *hub.keys,
                       F.lit(run_ts).alias("load_dts"), F.lit(RECORD_SOURCE).alias("record_source"))


def link_candidates(fct: DataFrame, link: Link, run_ts) -> DataFrame:
    pairs = fct.where(_not_null(link.keys)).select(*link.keys).distinct()
    return pairs.select(surrogate_key(*link.keys).alias(link.hk),
                        *[surrogate_key(*k).alias(name) for name, k in link.hubs],
                        F.lit(run_ts).alias("load_dts"), F.lit(RECORD_SOURCE).alias("record_source"))


def insert_only_delta(candidates: DataFrame, target: DataFrame | None, hk: str) -> DataFrame:
    """Rows of ``candidates`` whose hash key is not yet in ``target``."""
    if target is None:
        return candidates
    return candidates.join(target.select(hk), hk, "left_anti")


def satellite_source(fct: DataFrame, columns: list[str], run_ts, collapse: bool = False) -> DataFrame:
    """Satellite payload at fact row grain (as the reference: repeated ids
    give several rows per key, trap 11).  ``collapse=True`` keeps one row per
    key: the payload of the last row of the key's grain order.  Rows that
    the numbering knows to be alone in their grain (``_alone``) are their
    key's last ones and are not grouped."""
    src = fct.where(F.col("transaction_id").isNotNull())
    if collapse:
        keys = ["company", "transaction_id"]
        payload = F.struct(*[F.col(c) for c in columns])
        last = lambda rows: (rows.groupBy(*keys).agg(F.max_by(payload, F.col("_row_in_grain")).alias("p"))
                             .select(*keys, "p.*"))
        src = (src.where("_alone").select(*keys, *columns).unionByName(last(src.where("not _alone")))
               if "_alone" in src.columns else last(src))
    return src.select(
        surrogate_key("company", "transaction_id").alias("transaction_hk"),
        *columns,
        F.lit(run_ts).alias("load_dts"), F.lit(RECORD_SOURCE).alias("record_source"),
        hashdiff(*columns).alias("hashdiff"))


def latest_versions(target: DataFrame) -> DataFrame:
    """(transaction_hk, latest_hashdiff), both packed: every key's latest
    stored hashdiff, ties on load_dts broken by hashdiff."""
    return (target.select(packed("transaction_hk").alias("transaction_hk"), "load_dts", packed("hashdiff").alias("d"))
            .groupBy("transaction_hk").agg(F.max(F.struct("load_dts", "d")).alias("v"))
            .select("transaction_hk", F.col("v.d").alias("latest_hashdiff")))


def satellite_delta(source: DataFrame, target: DataFrame | None) -> DataFrame:
    """Rows to append: new keys, or payload differing from the latest
    stored version.  The guard compares only to the latest version, so
    A -> B -> A appends twice.  Digests are exchanged in 16 bytes."""
    if target is None:
        return source
    digests = ("transaction_hk", "hashdiff")
    j = source.withColumns({c: packed(c) for c in digests}).join(latest_versions(target), "transaction_hk", "left")
    return (j.where(F.col("latest_hashdiff").isNull() | (F.col("latest_hashdiff") != F.col("hashdiff")))
            .select(*[unpacked(c).alias(c) if c in digests else c for c in source.columns]))
