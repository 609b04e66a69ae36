"""Chat formatting of reply trees.

Messages name the message they reply to.  Iterative self-joins double the
ancestor links (after k rounds every message knows its 2**k-th ancestor), so
depth and root of every message, and the rows of every root-to-leaf path, take
log2(depth) rounds however long a conversation is.  A path's score is the mean
of its messages' scores to nine decimals; the best ``keep`` paths of every root are formatted,
one conversation per path (ties: the smaller leaf id).

The template writes each message as ``<|im_start|>role\\ntext<|im_end|>\\n``.
Control strings inside roles and texts are escaped by a backslash behind their
first character (backslashes already there get one more), so parsing the
output gives the turns back exactly.  The loss mask is a list of character
spans (code points) that cover each assistant text and nothing between.

Defined results: null text is the empty text and null role the empty role; a
null score counts 0; a message whose parent is missing starts a tree; cycles
have no root and give no path; repeated rows of one message id count once; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, prepare, stage

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings that are escaped inside texts (fixed values of public
#: chat templates, this one's first).
CONTROL = [START, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|eot_id|>",
           "<|start_header_id|>", "<|end_header_id|>"]
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
ESCAPE = rf"([<\[])(\\*)({_TAILS})"
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_TAILS})")


def escape(column):
    """Text with its control strings made harmless."""
    return F.regexp_replace(column, ESCAPE, r"$1$2\\$3")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def escape_role(column):
    """A role on one line, its control strings made harmless."""
    return escape(F.replace(F.replace(column, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(text: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


def leaf_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """(leaf, message, step) rows of the chosen root-to-leaf paths; step
    counts from the root.  ``messages``: id, parent, score."""
    nodes = stage(messages.groupBy("id").agg(F.first("parent").alias("parent"), F.max("score").alias("score")), "nodes")
    known = nodes.select(F.col("id").alias("parent"))
    up = stage(nodes.join(known, "parent", "left_semi").select("id", F.col("parent").alias("up")), "links")
    kids = up.select(F.col("up").alias("id")).distinct()
    leaves = nodes.join(kids, "id", "left_anti").select("id")
    # rows (leaf, message, distance from the leaf), doubled round by round
    paths = stage(leaves.select(F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("far")), "paths")
    rounds = 0
    while not up.isEmpty():
        longer = paths.join(up, "id").select("leaf", F.col("up").alias("id"), (F.col("far") + (1 << rounds)).alias("far"))
        paths = stage(paths.unionByName(longer), "paths")
        above = up.select(F.col("id").alias("up"), F.col("up").alias("top"))
        up = stage(up.join(above, "up").select("id", F.col("top").alias("up")), "links")
        rounds += 1
        if longer.isEmpty():                     # what is left are cycles without leaves
            break
    scored = paths.join(nodes.select("id", "score"), "id")
    whole = scored.groupBy("leaf").agg(
        F.max("far").alias("depth"), F.round(F.avg(F.coalesce("score", F.lit(0.0))), 9).alias("score"),
        F.max_by("id", "far").alias("root"))
    rank = F.row_number().over(Window.partitionBy("root").orderBy(F.col("score").desc(), "leaf"))
    chosen = whole.withColumn("rank", rank).where(F.col("rank") <= keep).select("leaf", "depth")
    return paths.join(chosen, "leaf").select("leaf", "id", (F.col("depth") - F.col("far")).alias("step"))


def format_trees(messages: DataFrame, keep: int = 1) -> DataFrame:
    """conv_id, leaf, formatted, loss_spans of every chosen path.

    ``messages``: id, parent, conv_id, role, text, score."""
    prepare(messages.sparkSession)
    rows = stage(pick(messages, id="id", parent="parent", conv_id="conv_id", role="role", text="text", score="score")
                 .withColumn("role", F.coalesce("role", F.lit(""))).withColumn("text", F.coalesce("text", F.lit(""))),
                 "messages")
    paths = leaf_paths(rows.select("id", "parent", "score"), keep)
    body = rows.groupBy("id").agg(F.min(F.struct("conv_id", "role", "text")).alias("m")).select(
        "id", "m.conv_id", F.col("m.role").alias("role"), escape(F.col("m.text")).alias("text"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    turn = body.select("id", "conv_id", F.struct(
        F.char_length(head).cast("long").alias("lead"), F.char_length("text").cast("long").alias("size"),
        (F.col("role") == "assistant").alias("loss"),
        F.concat(head, "text", F.lit(END + "\n")).alias("piece")).alias("t"))
    tail = len(END) + 1
    gathered = paths.join(turn, "id").groupBy("leaf").agg(
        F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(F.struct("step", "t"))).alias("turns"))
    state = F.aggregate(
        "turns", F.struct(F.lit(0).cast("long").alias("at"),
                          F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + x["t"]["lead"] + x["t"]["size"] + tail).alias("at"),
            F.when(x["t"]["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + x["t"]["lead"]).alias("begin"),
                (acc["at"] + x["t"]["lead"] + x["t"]["size"]).alias("end"))))).otherwise(acc["spans"]).alias("spans")))
    return gathered.select("conv_id", "leaf", F.array_join(F.transform("turns", lambda x: x["t"]["piece"]), "").alias(
        "formatted"), state["spans"].alias("loss_spans"))


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns = []
    for block in formatted.split(END + "\n")[:-1]:
        role, text = block[len(START):].split("\n", 1)
        turns.append((unescape_role(role), unescape(text)))
    return turns


def _read_back(batches):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            turns = read_turns(row["formatted"])
            loss = "".join(unescape(row["formatted"][s["begin"]:s["end"]]) for s in row["loss_spans"])
            out.append((row["conv_id"], len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss),
                        len(row["formatted"])))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*out)) if out else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations and loss masks hold."""
    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(
        _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long")


def replies_of_turns(turns: DataFrame) -> DataFrame:
    """Messages of a (conv_id, turn, role, text) table: each turn replies to
    the one before it in its conversation (equal turns by role and text)."""
    rows = pick(turns, conv_id="conv_id", turn="turn", role="role", text="text").withColumn(
        "conv_id", F.col("conv_id").cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = rows.withColumn("place", F.row_number().over(order).cast("long"))
    name = lambda p: F.struct(F.col("conv_id").alias("c"), p.alias("p"))
    return place.select(name(F.col("place")).alias("id"),
                        F.when(F.col("place") > 1, name(F.col("place") - 1)).alias("parent"),
                        "conv_id", "role", "text", F.lit(0.0).alias("score"))
