"""Written tables in the shared folder.

``stage`` writes a DataFrame once as parquet under the cluster's shared
checkpoint folder and returns a scan of it: lineage is cut (a lost executor
re-reads files instead of recomputing the chain), the data is computed once
(``DataFrame.checkpoint`` computes its input twice unless it is cached) and
later readers get columnar pruning and push-down.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import shared_path


def stage(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    spark = df.sparkSession
    path = shared_path(spark, "stage", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.parquet(path)


#: Hash keys are digits in hex: zstd takes them to half, the default does not.
COMPACT = {"compression": "zstd"}


def write(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").options(**COMPACT).partitionBy(*partitions).parquet(path)


def remove(spark, path: str) -> None:
    """Remove a folder of this library's own intermediate files."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
