"""A trie of conversation prefixes, totals rolled up by bands of depth.

``rebuild`` gives every conversation the turns it is made of; ``prefix_trie``
finds the distinct prefixes (nodes) and what lies below each.

* A turn is hashed with its place; the running sums of a conversation's turn
  hashes (four of 32 bits) name its prefixes, so equal prefixes of any two
  conversations get the same name and no list of turns is ever gathered.  The
  sums come from a sorted window that keeps a few numbers, whatever the
  conversation's length.  (Names are 128 bits of such sums: two different
  prefixes share one with a probability of about 2^-128.)
* Totals over subtrees go up by bands of ``BAND`` depths.  Within a band each
  node is exploded to its ancestors up to the band's root, less than ``BAND``
  of them.  The band roots then form a trie of their own, ``BAND`` times
  flatter, which is treated in the same way; its finished totals are handed to
  the ``BAND`` ancestors in the band above.  A trie of depth d takes
  log(d) / log(BAND) rounds and no row is exploded into more than ``BAND``.
  Sums are pre-aggregated before each exchange, so a root that all
  conversations share is no hot key.
* The ids of the conversations that end at a node are digested in id order as
  they stream by, sorted; the state is one hash.

Defined results: turns of equal number are taken in the order of role and
text, a null number first; null role or text is read as empty; rows without a
conv_id belong to no conversation and are left out; a conversation without
turns ends at the root; repeated rows are turns of their own; an empty table
has no node, not even a root; other columns stay out of the plan.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blank, pick, prepare, stage

#: Depths in a band.
BAND = 16
#: Every conversation takes the head of the first one of its block of ids.
BLOCK, HEADS = 20, 4
_WORDS = r"[^\x20\x09-\x0D]+"


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, role, text) by turn."""
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text").where("conv_id is not null")
    rows = rows.select(F.col("conv_id").cast("long"), "turn", blank("role").alias("role"), blank("text").alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.withColumn("place", F.row_number().over(order).cast("long")).drop("turn")


def _head_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("int")


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, role, text) of the rebuilt conversations, and every
    conv_id: the head is the first h turns of conversation c - c % 20, h =
    crc32(c) % 4, then come c's own turns behind its first h."""
    turns = stage(ordered_turns(conversations), "trie-turns")
    convs = turns.select("conv_id").distinct().withColumn("h", _head_length(F.col("conv_id")))
    # at most three turns a head, and at most 2 * BLOCK - 1 conversations that take it
    heads = turns.where((F.col("conv_id") % BLOCK == 0) & (F.col("place") < HEADS)).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("head")).withColumnRenamed("conv_id", "base")
    taken = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK).join(heads, "base", "left").select(
        "conv_id", "h", F.coalesce(F.slice("head", 1, F.col("h")), F.array().cast(heads.schema["head"].dataType)).alias("head"))
    taken = stage(taken, "trie-heads")
    first = taken.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.place", "t.role", "t.text")
    # h is computed from the id itself: only the head's length is looked up
    own = turns.where(F.col("place") > _head_length(F.col("conv_id"))).join(
        taken.select("conv_id", F.size("head").alias("n")), "conv_id").select(
        "conv_id", (F.col("place") - _head_length(F.col("conv_id")) + F.col("n")).alias("place"), "role", "text")
    return first.unionByName(own), taken.select("conv_id")


def _named(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, d, id, words) of every prefix of every conversation, the
    empty one (d = 0) too."""
    text = F.concat_ws(":", F.col("place").cast("string"), F.length("role").cast("string"), "role", "text")
    rows = turns.select("conv_id", F.col("place").alias("d"), F.md5(text).alias("m"),
                        F.regexp_count("text", F.lit(_WORDS)).cast("long").alias("words"))
    rows = rows.unionByName(convs.select("conv_id", F.lit(0).cast("long").alias("d"), F.lit("0" * 32).alias("m"),
                                         F.lit(0).cast("long").alias("words")))
    along = Window.partitionBy("conv_id").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    parts = [F.sum(F.conv(F.substring("m", 8 * k + 1, 8), 16, 10).cast("long")).over(along).cast("string") for k in range(4)]
    return rows.select("conv_id", "d", F.unhex(F.md5(F.concat_ws(",", F.col("d").cast("string"), *parts))).alias("id"), "words")


def _with_ancestors(prefixes: DataFrame, depth: str) -> DataFrame:
    """``up``: the names of a prefix's ancestors back to the root of its
    band; of a band root those of the whole band above."""
    back = F.collect_list("id").over(Window.partitionBy("conv_id").orderBy(depth).rowsBetween(-BAND, -1))
    within = F.when(F.col(depth) % BAND == 0, F.lit(BAND)).otherwise(F.col(depth) % BAND).cast("int")
    take = F.least(within, F.size("back"))
    return prefixes.withColumn("back", back).withColumn("up", F.when(
        take > 0, F.slice("back", -take, take)).otherwise(F.array().cast("array<binary>"))).drop("back")


def _rolled(prefixes: DataFrame, values: DataFrame, most: int, measures: list[str], level: int = 0) -> DataFrame:
    """(id, measures): sums of ``values`` (id, measures) over every subtree of
    the trie whose members' paths are ``prefixes`` (conv_id, id, d)."""
    sums = [F.sum(m).alias(m) for m in measures]
    paths = _with_ancestors(prefixes, "d").groupBy("id").agg(F.min("d").alias("d"), F.first("up").alias("up"))
    nodes = stage(paths.join(values, "id"), f"trie-paths-{level}")
    is_root = F.col("d") % BAND == 0
    reach = F.concat(F.array("id"), F.when(~is_root, F.col("up")).otherwise(F.array().cast("array<binary>")))
    banded = stage(nodes.select(F.explode(reach).alias("id"), *measures).groupBy("id").agg(*sums), f"trie-band-{level}")
    if most < BAND:                    # one band: its totals are whole
        return banded
    roots = nodes.where(is_root).select("id", "d", "up")
    flat = prefixes.where(is_root).select("conv_id", "id", (F.col("d") / BAND).cast("long").alias("d"))
    above = _rolled(flat, roots.select("id").join(banded, "id"), most // BAND, measures, level + 1)
    handed = roots.join(above, "id").select(F.explode("up").alias("id"), *measures)
    # a root's total is finished; the others add what comes from the next band
    finished = nodes.select("id", is_root.alias("root"))
    lower = handed.join(finished.where("not root").select("id"), "id", "left_semi")
    rest = banded.join(finished.where("not root").select("id"), "id", "left_semi")
    rest = rest.unionByName(lower).groupBy("id").agg(*sums)
    return stage(rest.unionByName(above), f"trie-whole-{level}")


def _digest(batches):
    """(id, digest) of runs of rows that are sorted by id and conv_id."""
    now, state = None, None
    for batch in batches:
        ids, out = batch.column("id").to_pylist(), []
        convs = batch.column("conv_id").to_pylist()
        start = 0
        for i in range(len(ids) + 1):
            if i < len(ids) and ids[i] == ids[start]:
                continue
            if start < len(ids):
                if ids[start] != now:
                    if state is not None:
                        out.append((now, state.hexdigest()))
                    now, state, lead = ids[start], hashlib.sha256(), ""
                else:
                    lead = ","
                state.update((lead + ",".join(map(str, convs[start:i]))).encode())
            start = i
        yield _digest_rows(out)
    if state is not None:
        yield _digest_rows([(now, state.hexdigest())])


def _digest_rows(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                       pa.array([r[1] for r in rows], pa.string())], ["id", "ends_sha256"])


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: id, parent, conv_id (the smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (words that a
    store of prefixes saves below the node), ends_sha256 (ids of the members
    that end there).  ``turns`` has conv_id, place (1, 2, ...), role, text."""
    prepare(turns.sparkSession)
    prefixes = stage(_named(turns, convs).withColumn(
        "parent", F.lag("id").over(Window.partitionBy("conv_id").orderBy("d"))), "trie-prefixes")
    nodes = stage(prefixes.groupBy("id").agg(
        F.min("conv_id").alias("conv_id"), F.min("d").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"), F.max("parent").alias("parent")), "trie-nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stage(nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-nodes")
    most = nodes.agg(F.max("depth")).first()[0]
    if most is None:
        most = 0
    values = nodes.select("id", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                          ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = _rolled(prefixes.select("conv_id", "id", "d"), values, most, ["n_leaves", "saved_tokens"])
    last = Window.partitionBy("conv_id").orderBy("d")
    ends = prefixes.withColumn("next", F.lead("d").over(last)).where("next is null").select("id", "conv_id")
    ends = ends.repartition("id").sortWithinPartitions("id", "conv_id").mapInArrow(_digest, "id binary, ends_sha256 string")
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(parents, "parent", "left").join(totals, "id").join(ends, "id", "left").select(
        "id", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
