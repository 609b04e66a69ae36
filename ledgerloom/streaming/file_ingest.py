"""Continuous file ingest with Structured Streaming.

A file-source stream over the drop folder replaces the blob-event queue and
pipe: the checkpoint is the load history, so a file is loaded exactly once
(a rerun with ``availableNow`` loads nothing; a new file loads alone).
Each micro-batch is routed, split and written exactly like a batch load
(``sources.landing``); the landing write goes to ``load_id=<query id>-<batch
id>`` with overwrite (the query id lives as long as its checkpoint, so streams
that share a landing root, or a new checkpoint, never overwrite each other),
quarantine capture anti-joins on the MERGE key, and the batch is seen once its
manifest entry is written, so a batch that dies half-way shows nothing and its
re-execution duplicates nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import landing as L


def raw_stream(spark: SparkSession, drop: str, max_files_per_trigger: int | None = None,
               multi_line: bool = False) -> DataFrame:
    reader = spark.readStream.schema(L.raw_schema()).options(**L.csv_options(multi_line))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(drop).select("*", "_metadata.file_path", "_metadata.file_block_start")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's id as its checkpoint records it."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def make_batch_writer(landing_root: str, quarantine_path: str, checkpoint: str, run_ts=None, shapes=L.SHAPES):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stamp = F.lit(run_ts).cast("timestamp_ntz") if run_ts else F.current_timestamp().cast("timestamp_ntz")
        rows = batch.withColumns({
            "_file": L.logical_file_name(F.col("file_path")), "_row": F.monotonically_increasing_id()}) \
            .withColumnsRenamed({"file_path": "_path", "file_block_start": "_block"})
        load_id = f"stream-{query_id(spark, checkpoint)}-{batch_id:08d}"
        L.land(L.route(rows), landing_root, quarantine_path, stamp, load_id, shapes)
    return write_batch


def start_file_ingest(spark: SparkSession, drop: str, landing_root: str, quarantine_path: str,
                      checkpoint: str, run_ts=None, available_now: bool = True,
                      processing_time: str = "1 minute", max_files_per_trigger: int | None = None,
                      multi_line: bool = False) -> StreamingQuery:
    """Start the ingest stream.  ``available_now`` processes everything that
    is there and stops (the scheduled-run form); otherwise it polls every
    ``processing_time``."""
    writer = (raw_stream(spark, drop, max_files_per_trigger, multi_line).writeStream
              .foreachBatch(make_batch_writer(landing_root, quarantine_path, checkpoint, run_ts))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
