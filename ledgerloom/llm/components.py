"""Connected components of a link table of any size.

Each task first replaces its own links by a union-find forest.  Then large-star
and small-star rounds alternate: every vertex's larger, then smaller,
neighbours are linked to the smallest vertex in reach, until nothing changes.
Every round is a written table, minima are pre-aggregated, and no component
is ever gathered in one task."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _forest(batches):
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root:
            parent[x] = root
            x = up
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 1_000_000:        # bounded memory: hand on what is known
            yield _rows(parent, find)
            parent.clear()
    yield _rows(parent, find)


def _rows(parent, find) -> pa.RecordBatch:
    keys = list(parent)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([find(k) for k in keys], pa.int64())],
                                      ["a", "b"])


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(vertex, root) of every linked vertex that is not its component's
    smallest; ``links`` has long columns ``a`` and ``b``."""
    links = stage(links.mapInArrow(_forest, "a long, b long").distinct(), "links")
    before = _state(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.where(F.col("a") != F.col("b")).distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        links = stage(small.select("e.a", "e.b").where(F.col("a") != F.col("b")).distinct(), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
