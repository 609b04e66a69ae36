"""SCD-2 snapshot of the policy dimension (H1), its history view (D7) and
point-in-time lookup (D8).

Check strategy: a version is opened per key; when any check column changes
(null-safe comparison) the open version is closed at the run timestamp and
a new one opened.  Unchanged keys are untouched; keys absent from the new
state stay open (hard deletes are not invalidated).

Closed versions are append-only; open versions are rewritten by the bucket
(see the store layout in ``plans.build``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: the snapshot's check columns ----------------------------
CHECK_COLUMNS = [
    "policy_status", "product_name", "member_id", "income_bracket", "smoker_status", "age_next",
    "life_sum_assured", "life_premium", "disability_type", "disability_sum_assured",
    "disability_premium", "chronic_level", "chronic_waiting_period", "chronic_premium",
    "accident_benefit", "accident_premium", "total_monthly_premium", "commission_rate",
]
UNIQUE_KEY = "policy_sk"
META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]
OPEN_VALID_TO = "9999-12-31 00:00:00"


def scd_id(key_col: str, ts) -> F.Column:
    """md5 of key '|' timestamp text (NULL parts as '')."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col(key_col).cast("string"), F.lit("")),
                             F.coalesce(F.lit(ts).cast("string"), F.lit(""))))


def _new_versions(state: DataFrame, run_ts) -> DataFrame:
    return state.select("*", scd_id(UNIQUE_KEY, run_ts).alias("dbt_scd_id"),
                        F.lit(run_ts).alias("dbt_updated_at"), F.lit(run_ts).alias("dbt_valid_from"),
                        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"))


def first_snapshot(state: DataFrame, run_ts) -> DataFrame:
    return _new_versions(state, run_ts)


def changed(check_cols=CHECK_COLUMNS, left: str = "o", right: str = "n") -> F.Column:
    return reduce(lambda a, b: a | b,
                  [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in check_cols])


def after_run(snapshot: DataFrame, state: DataFrame, run_ts, check_cols=CHECK_COLUMNS) -> DataFrame:
    """The versions that a run leaves behind, from one join (one exchange of
    each side on the key) with the open versions of ``snapshot``: a changed
    open version gives its closed form (``_closed``) and a new version, another
    open version stays, a new key gives a new version."""
    columns = snapshot.columns
    o = snapshot.where(F.col("dbt_valid_to").isNull()).alias("o")
    j = o.join(state.alias("n"), F.col(f"o.{UNIQUE_KEY}") == F.col(f"n.{UNIQUE_KEY}"), "full_outer")
    old, new = F.col(f"o.{UNIQUE_KEY}").isNotNull(), F.col(f"n.{UNIQUE_KEY}").isNotNull()
    change = old & new & changed(check_cols)
    fresh = {"dbt_scd_id": scd_id(f"n.{UNIQUE_KEY}", run_ts), "dbt_updated_at": F.lit(run_ts).cast("timestamp_ntz"),
             "dbt_valid_from": F.lit(run_ts).cast("timestamp_ntz"), "dbt_valid_to": F.lit(None).cast("timestamp_ntz")}
    kept = F.struct(*[F.when(change, F.lit(run_ts).cast("timestamp_ntz")).alias(c) if c == "dbt_valid_to"
                      else F.col(f"o.{c}").alias(c) for c in columns], change.alias("_closed"))
    added = F.struct(*[fresh[c].alias(c) if c in fresh else F.col(f"n.{c}").alias(c) for c in columns],
                     F.lit(False).alias("_closed"))
    out = F.array_compact(F.array(F.when(old, kept), F.when(change | ~old, added)))
    return j.select(F.explode(out).alias("v")).select("v.*")


def snapshot_run(snapshot: DataFrame | None, state: DataFrame, run_ts) -> DataFrame:
    """Whole snapshot after one run (history ∪ newly closed ∪ open)."""
    if snapshot is None:
        return first_snapshot(state, run_ts)
    closed_before = snapshot.where(F.col("dbt_valid_to").isNotNull())
    return closed_before.unionByName(after_run(snapshot, state, run_ts).drop("_closed"))


HISTORY_COLUMNS = [
    "policy_sk", "company", "policy_number", "policy_universe", "inception_date", "policy_status",
    "member_id", "age_next", "smoker_status", "income_bracket", "product_name", "life_sum_assured",
    "life_premium", "disability_type", "disability_sum_assured", "disability_premium", "chronic_level",
    "chronic_waiting_period", "chronic_premium", "accident_benefit", "accident_premium",
    "total_monthly_premium", "commission_rate",
]


def dim_policy_history(snapshot: DataFrame) -> DataFrame:
    """House-style validity columns over the snapshot."""
    return snapshot.select(
        *HISTORY_COLUMNS,
        F.col("dbt_valid_from").alias("valid_from"),
        F.coalesce(F.col("dbt_valid_to"), F.lit(OPEN_VALID_TO).cast("timestamp_ntz")).alias("valid_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"),
        F.col("dbt_scd_id").alias("policy_version_id"),
        F.col("dbt_updated_at").alias("version_recorded_at"),
        "_loaded_at")


def policy_as_of(history: DataFrame, ts) -> DataFrame:
    """The version of every policy valid at ``ts``."""
    t = F.lit(ts).cast("timestamp_ntz")
    return history.where((F.col("valid_from") <= t) & (t < F.col("valid_to")))


def point_in_time_join(facts: DataFrame, history: DataFrame, ts_col: str,
                       key: str = "policy_sk") -> DataFrame:
    """D8 as a join: each fact row gets the policy version valid at its own
    timestamp (``pit_*`` columns, null if there is none).

    An as-of join without a range join: versions and facts of a key and month
    are sorted together and every fact takes the last version before it, so a
    key with many versions is not expanded.  A month also starts with the
    version that the months before it left behind (a running last over one
    row a key and month), so a hot key is spread over its months.  Facts
    without key or time never meet a version and are not shuffled.  The
    versions of a key do not overlap; empty ones (``valid_from`` not before
    ``valid_to``) are left out."""
    carried = [c for c in history.columns if c != key]
    month = F.trunc(F.col("at").cast("date"), "month").alias("month")
    v = (history.where(F.col(key).isNotNull() & (F.col("valid_from") < F.col("valid_to")))
         .select(F.col(key).alias("k"), F.col("valid_from").cast("timestamp_ntz").alias("at"),
                 F.struct(*[F.col(f"`{c}`") for c in carried]).alias("v")).select("*", month))
    f = facts.select(F.col(key).alias("k"), F.col(ts_col).cast("timestamp_ntz").alias("at"),
                     F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("f")).select("*", month)
    placed = F.col("k").isNotNull() & F.col("at").isNotNull()
    nothing = F.lit(None).cast(v.schema["v"].dataType)
    ends = v.groupBy("k", "month").agg(F.max_by("v", F.struct("at", "v.valid_to")).alias("v"))
    months = f.where(placed).select("k", "month").distinct().select("*", nothing.alias("v"))
    before = Window.partitionBy("k").orderBy("month").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # the range frame takes a month's own end in: the step back is a lag over months
    steps = ends.unionByName(months).groupBy("k", "month").agg(F.first("v", ignorenulls=True).alias("v"))
    left = steps.withColumn("v", F.last("v", ignorenulls=True).over(before)).withColumn(
        "v", F.lag("v").over(Window.partitionBy("k").orderBy("month")))
    none = F.lit(None).cast(f.schema["f"].dataType).alias("f")
    rows = (f.where(placed).select("k", "month", "at", F.lit(2).alias("kind"), "f", nothing.alias("v"))
            .unionByName(v.select("k", "month", "at", F.lit(1).alias("kind"), none, "v"))
            .unionByName(left.where("v is not null").select(
                "k", "month", F.col("month").cast("timestamp_ntz").alias("at"), F.lit(0).alias("kind"), none, "v")))
    so_far = Window.partitionBy("k", "month").orderBy("at", "kind", "v.valid_to").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    met = rows.withColumn("v", F.last("v", ignorenulls=True).over(so_far)).where("f is not null").select(
        "f", F.when(F.col("at") < F.col("v.valid_to"), F.col("v")).alias("v"))
    met = met.unionByName(f.where(~placed).select("f", nothing.alias("v")))
    return met.select(*[F.col("f").getField(c).alias(c) for c in facts.columns],
                      *[F.col("v").getField(c).alias(f"pit_{c}") for c in carried])
