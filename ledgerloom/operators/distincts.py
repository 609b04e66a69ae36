"""Exact distinct counts that roll up.

A mart's distinct counts per month cannot be added (trap 17).  Here every
client gets a number, and a group's clients are a set of bitmaps that can be
united over any of the mart's dimensions: rolling up from fund and month to
fund type reads the small bitmap table and never the fact.

Numbers are dense inside hash parts (no task numbers all clients): client =
(part, place), place = 0, 1, ... within the part.  A bitmap covers one block
of places, so a group holds at most clients / 32,768 + parts of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hash parts in which clients are numbered.
PARTS = 64


def numbered(keys: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """(key, part, block, bit) of every distinct key that is not null."""
    rows = keys.where(F.col(key).isNotNull()).select(key).distinct()
    rows = rows.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    place = (F.row_number().over(Window.partitionBy("part").orderBy(key)) - 1).cast("bigint")
    return rows.withColumn("place", place).select(
        key, "part", F.floor(F.col("place") / 32768).cast("int").alias("block"), (F.col("place") % 32768).alias("bit"))


def distinct_sets(rows: DataFrame, key: str, dims: list[str], parts: int = PARTS) -> DataFrame:
    """(dims, part, block, bits): the keys of every group as bitmaps.  A group
    of null keys only has none."""
    sets = rows.select(*dims, key).where(F.col(key).isNotNull()).distinct().join(numbered(rows, key, parts), key)
    return sets.groupBy(*dims, "part", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merge_sets(sets: DataFrame, dims: list[str]) -> DataFrame:
    """The sets of coarser groups (``dims`` out of the table's columns)."""
    return sets.groupBy(*dims, "part", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(sets: DataFrame, dims: list[str], out: str) -> DataFrame:
    """(dims, out): exact distinct counts of the groups ``dims``."""
    return merge_sets(sets, dims).groupBy(*dims).agg(F.sum(F.bitmap_count("bits")).alias(out))
