"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet files written by other engines carry plain timestamps.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerloom", extra: dict | None = None) -> SparkSession:
    """Session used by tests and the bench.  A cluster passes its own master
    and sizing; nothing here hard-codes local paths except the scratch
    checkpoint folder, which is only set when the cluster names none."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = "12g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder: what ``spark.checkpoint.dir``
    names, else the folder the caller set with ``setCheckpointDir``.  Only a
    local master gets a scratch folder of its own; on a cluster a folder on
    one machine would be unreadable for the others."""
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    current = context._jsc.sc().getCheckpointDir()
    if not path and current.isDefined():
        return current.get().rsplit("/", 1)[0] if _is_application_folder(current.get()) else current.get()
    if not path:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ledgerloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    if not current.isDefined():
        context.setCheckpointDir(path)
    return path


def _is_application_folder(path: str) -> bool:
    """Spark appends a folder named by a UUID to the folder that was set."""
    return bool(re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", path.rstrip("/").rsplit("/", 1)[-1]))


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for persisted tables that
    cut lineage)."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), *parts])
