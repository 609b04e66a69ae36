"""The banded roll-up equals a plain walk over all prefixes."""

import hashlib
import random
import re
import zlib

import pytest

from ledgerloom.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, id string, d int, place int"


def plain(rows):
    convs = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    for c in convs:
        convs[c] = [(r, x) for _, r, x in sorted(convs[c])]
    rebuilt = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = convs.get(base, [])[:h] + convs[c][h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    out = []

    def below(node):
        todo = [node]
        while todo:
            n = todo.pop()
            yield n
            todo += kids.get(n, [])

    words = lambda n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
    for node, who in members.items():
        ends = sorted(c for c in who if len(rebuilt[c]) == len(node))
        tree = list(below(node))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids.get(node, [])),
                    sum(not kids.get(n) for n in tree), sum((len(members[n]) - 1) * words(n) for n in tree),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def ours(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    turns, convs = P.rebuild(df)
    got = P.prefix_trie(turns, convs).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    return sorted(map(tuple, got), key=repr)


def row(c, t, role, text):
    return (c, t, role, text, "x", 1, 2)


def test_awkward_rows(spark):
    rows = [row(0, 0, "user", "a b"), row(0, 1, "assistant", "c"), row(0, 1, "assistant", "c"), row(0, None, None, None),
            row(1, 5, "user", "a b"), row(1, 6, "user", ""), row(2, 0, "user", " \t "), row(25, 0, "user", "no base"),
            row(None, 0, "user", "no id"), row(-7, 0, "user", "a b"), row(-20, 0, "user", "q"), row(-20, 1, "user", "long " * 5000)]
    rows += [row(c, t, "user", f"same {t}") for c in range(40, 60) for t in range(4)]
    rows += [row(c, 0, "user", "one") for c in range(60, 75)]
    assert ours(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert ours(spark, []) == []


@pytest.mark.parametrize("band", [2, 3, 16])
def test_random_deep_tries(spark, monkeypatch, band):
    """Depths far beyond one band, shared heads and shared long stretches."""
    monkeypatch.setattr(P, "BAND", band)
    rng = random.Random(band)
    rows = []
    for c in range(30):
        for t in range(rng.choice([1, 2, 3, 5, 30])):
            rows.append(row(c, t, "user", rng.choice(["x", "y y"]) if rng.random() < 0.1 else "z z z"))
    assert ours(spark, rows) == plain(rows)


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [(*r, "x", 1, 2) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert ours(spark, rows) == plain(rows)
