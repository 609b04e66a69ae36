"""Quarantine of rejected rows and its operational queries (Q1-Q4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: quarantine table layout ---------------------------------
ERROR_COLUMNS = [
    ("pipe_name", "string"), ("error", "string"), ("file_name", "string"), ("line", "bigint"),
    ("character_pos", "bigint"), ("byte_offset", "bigint"), ("category", "string"), ("code", "string"),
    ("sql_state", "string"), ("column_name", "string"), ("row_number", "bigint"),
    ("row_start_line", "bigint"), ("rejected_record", "string"),
]
QUARANTINE_COLUMNS = ERROR_COLUMNS + [("captured_at", "timestamp_ntz")]
CAPTURE_LOOKBACK_MINUTES = 10
ALERT_LOOKBACK_MINUTES = 60


def merge_key(prefix: str = "") -> list:
    """The null-safe MERGE key: pipe, file, row number, line."""
    return [F.col(prefix + "pipe_name"),
            F.coalesce(F.col(prefix + "file_name"), F.lit("")),
            F.coalesce(F.col(prefix + "row_number"), F.lit(-1).cast("bigint")),
            F.coalesce(F.col(prefix + "line"), F.lit(-1).cast("bigint"))]


def _keyed(df: DataFrame) -> DataFrame:
    k = merge_key()
    return df.select("*", *[c.alias(f"_k{i}") for i, c in enumerate(k)])


def capture(errors: DataFrame, quarantine: DataFrame | None, run_ts,
            lookback_minutes: int | None = None) -> DataFrame:
    """Q1: rows of ``errors`` whose merge key is not yet in ``quarantine``,
    stamped ``captured_at = run_ts`` (MERGE ... WHEN NOT MATCHED THEN
    INSERT).  Rows of one batch sharing a key are inserted once: the
    smallest row by content, so reruns pick the same one.

    A scheduled capture over the load history passes ``lookback_minutes``
    (``CAPTURE_LOOKBACK_MINUTES``): only errors with ``error_ts`` in that
    window before ``run_ts`` are considered.  An ingest run captures its own
    errors, so it has no window."""
    if lookback_minutes is not None:
        now = F.lit(run_ts).cast("timestamp_ntz")
        errors = errors.where((F.col("error_ts") > now - F.expr(f"INTERVAL {int(lookback_minutes)} MINUTES"))
                              & (F.col("error_ts") <= now))
    batch = _keyed(errors.select(*[F.col(c).cast(t).alias(c) for c, t in ERROR_COLUMNS]))
    keys = [f"_k{i}" for i in range(4)]
    payload = F.struct(*[F.col(c) for c, _ in ERROR_COLUMNS])
    batch = batch.groupBy(*keys).agg(F.min(payload).alias("_p")).select(*keys, "_p.*")
    if quarantine is not None:
        existing = _keyed(quarantine).select(*keys)
        batch = batch.join(existing, keys, "left_anti")
    return batch.drop(*keys).withColumn("captured_at", F.lit(run_ts).cast("timestamp_ntz"))


def latest_failures(q: DataFrame, n: int = 100) -> DataFrame:
    """Q2."""
    return (q.select("pipe_name", "file_name", "error", "captured_at")
            .orderBy(F.col("captured_at").desc(), F.col("pipe_name"), F.col("file_name").asc_nulls_last(),
                     F.col("error").asc_nulls_last())
            .limit(n))


def errors_per_pipe(q: DataFrame, now: str, hours: int = 24) -> DataFrame:
    """Q3: errors per pipe captured in the last ``hours``."""
    t = F.lit(now).cast("timestamp_ntz")
    return (q.where(F.col("captured_at") > t - F.expr(f"INTERVAL {int(hours)} HOURS"))
            .groupBy("pipe_name").agg(F.count(F.lit(1)).alias("errors"))
            .orderBy(F.col("errors").desc(), "pipe_name"))


def alert(q: DataFrame, now: str, lookback_minutes: int = ALERT_LOOKBACK_MINUTES) -> DataFrame:
    """Q4: one row, ``alert`` true iff anything was captured in the window.
    ``limit(1)`` stops the scan at the first hit."""
    t = F.lit(now).cast("timestamp_ntz")
    hits = q.where(F.col("captured_at") > t - F.expr(f"INTERVAL {int(lookback_minutes)} MINUTES")).limit(1)
    return hits.agg((F.count(F.lit(1)) > 0).alias("alert"))
