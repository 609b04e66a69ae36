"""Repair of conversations whose turns break the role order.

Rows are exchanged once, by conversation, and then only sorted inside their
partition.  Two streams read them, each with a few numbers of state that are
carried across Arrow batches, whatever the conversation's length:

* the first reads every conversation from its last row to its first and keeps
  the cheapest cost that remains from each of four states (nothing yet, after
  a system, a user, an assistant turn).  It leaves one byte on each row, the
  back-pointers: two bits a state, the first letter of the cheapest rest (of
  equal costs the least letter, which gives the least string, since different
  first edits have different letters);
* the rows are sorted again, first to last (Spark's sort spills them with
  their byte when they do not fit), and the second stream follows the bytes
  from the empty state, counts, and digests the repaired turns as they pass.

A hot conversation is read by one task, as its state demands, but never held.

Defined results: a null role or text is one space; rows without a turn come
first, rows of equal turn in the order of role and text; rows without a
conv_id form one conversation, returned with a null id; a repeated row is a
duplicate of the first; a conversation that lost all rows has zeros, an empty
audit and the digest of nothing; an empty table gives an empty result; other
columns stay out of the plan.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, prepare

# --- fixed values: edits, their costs, faults and the role order ------------
EDITS, DELETE, INSERT, KEEP, REROLE = "DIKR", 0, 1, 2, 3
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
NONE, BLANK, DUPLICATE, TRUNCATED, GONE = 0, 1, 2, 3, 4
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
SPACES = " \t\n\x0b\x0c\r"
_NEVER = 1 << 60

ROWS = "conv string, pos long, turn long, has_turn boolean, role string, text string, fault int"
RESULT = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(conv_id:turn) % 20; a dropped row stays as
    ``gone`` so that its conversation is still known."""
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), space("role").alias("role"), space("text").alias("text"),
                       (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).alias("op"))
    rows = rows.withColumns({
        "text": F.when(F.col("op") == 1, "").when(F.col("op") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "role": F.when(F.col("op") == 4, "user").otherwise(F.col("role")), "gone": F.col("op") == 0})
    copies = F.when(F.col("op") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies)).select("conv_id", "turn", "role", "text", "gone")


def _fault(first: Column) -> Column:
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    return F.when(F.col("gone"), GONE).when(bare == "", BLANK).when(~first, DUPLICATE).when(
        ~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NONE)


def faulted(rows: DataFrame) -> DataFrame:
    """Rows with their place and first fault, exchanged once by conversation."""
    rows = rows.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))).repartition("conv")
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    same = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    rows = rows.withColumn("pos", F.row_number().over(order).cast("long")).withColumn("same", same)
    first = F.row_number().over(Window.partitionBy("conv", "same", "gone").orderBy("pos")) == 1
    return rows.withColumn("fault", _fault(first)).select(
        "conv", "pos", F.coalesce("turn", F.lit(0)).cast("long").alias("turn"), F.col("turn").isNotNull().alias("has_turn"),
        "role", "text", F.col("fault").cast("int"))


def _state_of(role: str) -> int:
    return {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(role[:1], START)


def _may_keep(state: int, role: int) -> bool:
    return role == FOLLOWS[state] or (state == START and role == SYSTEM)


#: What is left to pay behind the last row, from each state.
AT_END = (0, 2 * INSERT_COST, INSERT_COST, 0)


def step(rest: tuple, role: str, fault: int) -> tuple[tuple, int]:
    """Cheapest costs from before a row, given those behind it, and the byte
    of first letters."""
    must, extra, is_ = fault in (BLANK, DUPLICATE), TRUNCATED_COST * (fault == TRUNCATED), _state_of(role)
    direct = []
    for state in range(4):
        costs = [(DELETE_COST + rest[state], DELETE)]
        if not must:
            if is_ != START and _may_keep(state, is_):
                costs.append((extra + rest[is_], KEEP))
            costs.append((REROLE_COST + extra + rest[FOLLOWS[state]], REROLE))
        direct.append(min(costs))
    after_user = min(direct[USER][0], INSERT_COST + direct[ASSISTANT][0])
    after_assistant = min(direct[ASSISTANT][0], INSERT_COST + direct[USER][0])
    onward = (after_user, after_user, after_assistant, after_user)      # an insertion leads there
    out, byte = [], 0
    for state in range(4):
        cost, edit = min(direct[state], (INSERT_COST + onward[state], INSERT))
        out.append(cost)
        byte |= edit << (2 * state)
    return tuple(out), byte


def point_back(frames):
    """Rows from last to first, each with the byte of its back-pointers."""
    conv, rest = None, AT_END
    for frame in frames:
        bytes_ = []
        for c, role, fault in zip(frame["conv"], frame["role"], frame["fault"]):
            if c != conv:
                conv, rest = c, AT_END
            byte = 0
            if fault != GONE:
                rest, byte = step(rest, role, fault)
            bytes_.append(byte)
        yield frame.assign(back=pd.Series(bytes_, index=frame.index, dtype="int32"))


class _Walk:
    """One conversation, row by row from the first."""

    def __init__(self, conv: str):
        self.conv, self.state, self.audit, self.digest, self.any = conv, START, [], hashlib.sha256(), False
        self.count, self.cost, self.illegal, self.before = [0] * 5, 0, 0, None
        self.low = self.high = self.turn = None
        self.turns = 0

    def say(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.any else "") + role + ":" + text).encode())
        self.any = True

    def insert(self) -> None:
        self.state = FOLLOWS[self.state]
        self.audit.append("I")
        self.cost += INSERT_COST
        self.say(ROLE[self.state], "")

    def row(self, turn, has_turn, role, text, fault, back) -> None:
        if fault == GONE:
            return
        self.count[fault] += 1
        if has_turn:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high or self.high is None
            self.high = turn
        if self.before is not None:
            self.illegal += self.before + role[:1] not in LEGAL
        self.before = role[:1]
        while (edit := back >> (2 * self.state) & 3) == INSERT:
            self.insert()
        self.audit.append(EDITS[edit])
        if edit == DELETE:
            self.cost += DELETE_COST
            return
        self.cost += TRUNCATED_COST * (fault == TRUNCATED)
        if edit == REROLE:
            self.cost += REROLE_COST
            self.state = FOLLOWS[self.state]
            role = ROLE[self.state]
        else:
            self.state = _state_of(role)
        self.say(role, text)

    def result(self) -> tuple:
        while self.state in (SYSTEM, USER):
            self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, self.count[BLANK], self.count[DUPLICATE], self.count[TRUNCATED], self.illegal,
                self.cost, "".join(self.audit), self.digest.hexdigest())


def follow(frames):
    """One row a conversation: rows from first to last, along their bytes."""
    names, walk = [c.split()[0] for c in RESULT.split(", ")], None
    for frame in frames:
        out = []
        for conv, *row in zip(*[frame[c] for c in ("conv", "turn", "has_turn", "role", "text", "fault", "back")]):
            if walk is None or conv != walk.conv:
                if walk is not None:
                    out.append(walk.result())
                walk = _Walk(conv)
            walk.row(*row)
        yield pd.DataFrame(out, columns=names)
    if walk is not None:
        yield pd.DataFrame([walk.result()], columns=names)


def repair(rows: DataFrame) -> DataFrame:
    """conv_id and what its repair takes, one row a conversation.  ``rows``
    has conv_id, turn, role, text and ``gone`` (see ``damage``)."""
    prepare(rows.sparkSession)
    pointed = faulted(rows).sortWithinPartitions("conv", F.col("pos").desc()).mapInPandas(point_back, ROWS + ", back int")
    # a partition stays as it is: the second sort needs no exchange
    out = pointed.sortWithinPartitions("conv", "pos").mapInPandas(follow, RESULT)
    return out.select(F.when(F.col("conv") != " ", F.col("conv")).cast("long").alias("conv_id"), *out.columns[1:])
