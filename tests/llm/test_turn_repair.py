"""The streamed repair equals an exhaustive search."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

from ledgerloom.llm import turn_repair as R

SCHEMA = "conv_id long, turn long, role string, text string, pos int, conv string, fault string"


def damaged(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        op = zlib.crc32(key.encode()) % 20
        mine = out.setdefault(conv, [])
        if op == 0:
            continue
        text = "" if op == 1 else re.sub("[.!?]", "", text) if op == 2 else text
        role = "user" if op == 4 else role
        mine += [(turn, role, text)] * (2 if op == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, v in out.items()}


def plain(rows):
    """Every sequence of edits, the cheapest and then ASCII-least one."""
    faults, seen = [], set()
    for _, role, text in rows:
        chars = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("b" if not chars else "d" if (role, text) in seen else "t" if chars[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, last, inserted):
        """(cost, audit, repaired) of rows i.. behind a turn with initial ``last``."""
        found = []
        fits = lambda r: r == {"": "u", "s": "u", "u": "a", "a": "u"}[last] or (last == "" and r == "s")
        if i == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            for name in ("user", "assistant"):
                if fits(name[0]):
                    c, a, o = best(i, name[0], inserted + 1)
                    found.append((c + 2, "I" + a, ((name, ""),) + o))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, o = best(i + 1, last, 0)
            found.append((c + 3, "D" + a, o))
            if faults[i] not in ("b", "d"):
                more = faults[i] == "t"
                if role[:1] in ("s", "u", "a") and fits(role[:1]):
                    c, a, o = best(i + 1, role[0], 0)
                    found.append((c + more, "K" + a, ((role, text),) + o))
                for name in ("user", "assistant"):
                    if fits(name[0]):
                        c, a, o = best(i + 1, name[0], 0)
                        found.append((c + 2 + more, "R" + a, ((name, text),) + o))
        return min(found) if found else (10**9, "", ())

    cost, audit, out = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    joined = "\n".join(f"{r}:{t}" for r, t in out)
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256(joined.encode()).hexdigest())


def check(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = {r[0]: tuple(r)[1:] for r in R.repair(R.damage(df)).collect()}
    assert got == {c: plain(v) for c, v in damaged(rows).items()}


def row(c, t, role, text):
    return (c, t, role, text, 1, "x", "y")


def test_awkward_rows(spark):
    rows = [row(1, 0, "user", "Hi."), row(1, 1, "assistant", "Yes"), row(1, None, None, None), row(2, 3, "system", " \n"),
            row(3, 0, "system", "Be kind."), row(4, 5, "", "no role."), row(None, 1, "user", "lost."), row(None, None, "user", "x"),
            row(2**60 + 1, 2**55, "user", "big ids."), row(2**60 + 1, 2**55 + 7, "assistant", "ok! "),
            row(5, -4, "user", "a?"), row(5, 9, "tool", "long " * 4000 + ".")]
    rows += [row(6, t, "user", "again.") for t in range(12)] + [row(7, t, "assistant", f"{t}.") for t in range(9)]
    rows += [row(c, 0, "user", "only one.") for c in range(100, 160)]
    rows += rows[:3]
    check(spark, rows)
    assert R.repair(R.damage(spark.createDataFrame([], SCHEMA))).collect() == []


def test_random_conversations(spark):
    rng, rows = random.Random(5), []
    for c in range(250):
        for t in range(rng.randint(1, 9)):
            rows.append(row(c, rng.choice([t, t, t + 3, None]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool"]),
                            rng.choice(["Fine.", "So", "", "Why?", f"n{t}."])))
    check(spark, rows)


def test_state_is_carried_across_batches(spark):
    """A conversation of many Arrow batches gives what one batch gives."""
    rows = [row(9, t, ["user", "assistant", "user"][t % 3], f"turn {t}" + "."[: t % 5]) for t in range(110)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        check(spark, rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    check(spark, [(*r, 1, "x", "y") for r in df.collect()])


def test_one_exchange(spark):
    import contextlib
    import io
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        R.repair(R.damage(df)).explain()
    assert text.getvalue().count("Exchange") == 1
