"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Documents with equal texts form a group that must not be split.  A partial
partition is a tuple of ``n_shards`` byte sums.  Differencing repeatedly takes
the two partial partitions with the largest spread and adds them in opposite
order.  Because the result is again a partial partition, the method nests:

1. groups are hashed into blocks of bounded size, and each block is differenced
   to one partial partition inside one task;
2. the blocks' partial partitions (``n_shards`` numbers each) are differenced
   ``fan_in`` at a time, level by level, until one is left;
3. the slot maps of all levels are composed and joined back to the rows.

No task holds more than a block of groups and nothing goes through the driver
but row counts.

Defined results: null text weighs and groups like the empty text (size 1,
checksum 0); a null ``doc_id`` is kept; repeated rows are each placed and
numbered; an empty table gives an empty result; other columns are ignored.
Equal weights are ordered by group key, so a retried task repeats its result.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blank, pick, prepare, stage


def difference(partials: list[list[int]], k: int) -> list[list[int]]:
    """Difference ``k``-way partial partitions into one.

    ``partials[i]`` lists up to ``k`` sums; returns for each input the shard of
    each of its positions.  Sums are kept sorted downwards with the smallest
    subtracted; equal spreads are taken in input order."""
    nodes: list[list[int]] = []      # sums, sorted downwards
    made: list[tuple] = []           # leaf: (order,)  inner: (a, b, order)
    heap = []
    for i, sums in enumerate(partials):
        full = list(sums) + [0] * (k - len(sums))
        order = sorted(range(k), key=full.__getitem__, reverse=True)
        low = full[order[-1]]
        nodes.append([full[p] - low for p in order])
        made.append((order,))
        heap.append((-nodes[i][0], i))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = [x + y for x, y in zip(nodes[a], reversed(nodes[b]))]
        order = sorted(range(k), key=both.__getitem__, reverse=True)
        low = both[order[-1]]
        nodes.append([both[p] - low for p in order])
        made.append((a, b, order))
        nodes[a] = nodes[b] = None
        heapq.heappush(heap, (-nodes[-1][0], len(nodes) - 1))
    shard_of: list[list[int] | None] = [None] * len(made)
    if made:
        shard_of[-1 if len(made) > 1 else 0] = list(range(k))
    for i in range(len(made) - 1, -1, -1):
        own = shard_of[i]
        if len(made[i]) == 1:
            back = [0] * k
            for place, position in enumerate(made[i][0]):
                back[position] = own[place]
            shard_of[i] = back
            continue
        a, b, order = made[i]
        left, right = [0] * k, [0] * k
        for place, position in enumerate(order):
            left[position] = own[place]
            right[k - 1 - position] = own[place]
        shard_of[a], shard_of[b], shard_of[i] = left, right, None
    return shard_of[: len(partials)]


def _difference_groups(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["weight", "group"], ascending=[False, True], kind="stable")
        slots = difference([[w] for w in pdf["weight"].tolist()], k)
        return pdf.assign(slot=[s[0] for s in slots])[["node", "group", "weight", "slot"]]
    return run


def _difference_nodes(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.sort_values(["node", "slot"]).groupby("node", sort=True)
        nodes, sums = [], []
        for node, part in wide:
            row = [0] * k
            for slot, weight in zip(part["slot"].tolist(), part["weight"].tolist()):
                row[slot] = weight
            nodes.append(node)
            sums.append(row)
        maps = difference(sums, k)
        return pd.DataFrame({
            "parent": pdf["parent"].iloc[0],
            "node": [n for n in nodes for _ in range(k)],
            "slot": [s for _ in nodes for s in range(k)],
            "up": [u for m in maps for u in m],
            "weight": [w for row in sums for w in row],
        })
    return run


def shard_documents(docs: DataFrame, n_shards: int = 16, block_groups: int = 50_000, fan_in: int = 256,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Place every row in one of ``n_shards`` shards of near-equal bytes,
    equal texts together, and number the rows of each shard without gaps.

    Returns doc_id, size (UTF-8 bytes + 1), text_crc32, law (``bytes``), shard,
    slot, grown_shard (null: this law moves rows when a shard is added)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = stage(pick(docs, doc_id=doc_id, text=text).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(blank("text")).alias("text_crc32"),
        F.md5(blank("text")).alias("group")), "shard-rows")
    n_rows = rows.count()
    n_blocks = max(1, math.ceil(n_rows / block_groups))

    groups = rows.groupBy("group").agg(F.sum("size").alias("weight")) \
        .withColumn("node", F.pmod(F.xxhash64("group"), F.lit(n_blocks)))
    placed = stage(groups.groupBy("node").applyInPandas(
        _difference_groups(n_shards), "node long, group string, weight long, slot int"), "shard-blocks")

    # compose the levels: (block, slot in block) -> slot in the level's node
    level = placed.groupBy("node", "slot").agg(F.sum("weight").alias("weight"))
    path = placed.select("node", "slot").distinct().select(
        F.col("node").alias("block"), F.col("slot").alias("block_slot"), "node", "slot")
    width = n_blocks
    while width > 1:
        up = stage(level.withColumn("parent", F.floor(F.col("node") / fan_in)).groupBy("parent").applyInPandas(
            _difference_nodes(n_shards), "parent long, node long, slot int, up int, weight long"), "shard-level")
        path = path.join(up.select("node", "slot", "parent", "up"), ["node", "slot"]) \
            .select("block", "block_slot", F.col("parent").alias("node"), F.col("up").alias("slot"))
        level = up.groupBy(F.col("parent").alias("node"), F.col("up").alias("slot")).agg(
            F.sum("weight").alias("weight"))
        width = math.ceil(width / fan_in)

    final = placed.select("group", F.col("node").alias("block"), F.col("slot").alias("block_slot")) \
        .join(path.select("block", "block_slot", F.col("slot").alias("shard")), ["block", "block_slot"]) \
        .select("group", "shard")
    n_buckets = max(1, math.ceil(n_rows / (n_shards * 20_000)))
    in_shard = stage(rows.join(final, "group").withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "group"), F.lit(n_buckets)).cast("int")), "shard-placed")

    # gapless numbers: rows before the bucket + place inside it
    before = in_shard.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "bucket",
        (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "group"))
    return in_shard.withColumn("place", place.cast("long")).join(before, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("before") + F.col("place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
