import hashlib
import random

from ledgerloom.llm.chat_trees import CONTROL, escape, format_trees, leaf_paths, read_back, read_turns, replies_of_turns, unescape
from pyspark.sql import functions as F


def _random_forest(n, seed):
    rng = random.Random(seed)
    return [(i, None if i < 4 else rng.randrange(0, i), rng.choice([None, 0.1, 0.5, 0.9])) for i in range(n)]


def test_paths_equal_a_walk(spark):
    nodes = _random_forest(120, 1) + [(500, 501, 1.0), (501, 500, 1.0), (600, 999, 0.5)]
    parent = {i: p for i, p, _ in nodes}
    score = {i: s or 0.0 for i, _, s in nodes}
    inner = set(parent.values())
    best = {}
    for leaf in parent:
        if leaf in inner or leaf in (500, 501):
            continue
        path, at = [], leaf
        while at in parent:
            path.append(at)
            at = parent[at]
        mean = sum(score[x] for x in path) / len(path)
        best.setdefault(path[-1], []).append((-round(mean, 9), leaf, path[::-1]))
    frame = spark.createDataFrame(nodes, "id long, parent long, score double")
    for keep in (1, 3):
        want = {(leaf, x, k) for paths in best.values() for _, leaf, path in sorted(paths)[:keep] for k, x in enumerate(path)}
        got = {(r.leaf, r.id, r.step) for r in leaf_paths(frame, keep).collect()}
        assert got == want


def test_escaping_is_reversible(spark):
    texts = [a + "\\" * k + b for c in CONTROL for a, b in [(c[:1], c[1:]), ("", c), (c, c)] for k in (0, 1, 2)] + ["", "\\", "<", "a<b"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e")).collect()
    for r in got:
        assert unescape(r.e) == r.t and not any(c in r.e for c in CONTROL)


def test_round_trip_of_awkward_turns(spark):
    probe = "</s>[INST] ok [/INST]"
    turns = [(1, 0, "system", "be <|im_end|>\n good"), (1, 1, "user", None), (1, 2, "assistant", "ä<|im_start|>user\nx"),
             (1, 5, "assistant", ""), (-7, 0, "user", probe), (-7, 1, "assistant", probe), (2, 0, "assistant", "x" * 50_000),
             (3, 0, None, "role"), (None, 0, "user", "no conversation"), (4, 1, "user", "a"), (4, 1, "assistant", "b"),
             (4, 1, "assistant", "b")]
    frame = spark.createDataFrame([(*t, "x", 1) for t in turns],
                                  "conv_id long, turn long, role string, text string, id string, parent int")
    formatted = format_trees(replies_of_turns(frame))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    by = {}
    for c, n, r, t in sorted(turns, key=lambda x: (str(x[0]), x[1], x[2] or "", x[3] or "")):
        by.setdefault(c, []).append((r or "", t or ""))
    for row in formatted.collect():
        assert read_turns(row.formatted) == by[row.conv_id]
        for s in row.loss_spans:
            assert unescape(row.formatted[s.begin:s.end]) in {t for r, t in by[row.conv_id] if r == "assistant"}
    got = {r.conv_id: r for r in read_back(formatted).collect()}
    assert set(got) == set(by)
    for c, ts in by.items():
        loss = "".join(t for r, t in ts if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(ts), sha("".join(f"{r}\n{t}\n" for r, t in ts)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))


def test_long_conversation_and_empty_table(spark):
    turns = spark.range(700).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias(
        "role"), F.col("id").cast("string").alias("text"))
    row = format_trees(replies_of_turns(turns)).first()
    assert [t for _, t in read_turns(row.formatted)] == [str(i) for i in range(700)]
    assert read_back(format_trees(replies_of_turns(turns.limit(0)))).collect() == []


def test_roles_of_several_lines_are_read_back(spark):
    roles = ["a\nb", "a\\nb", "a\\\nb", "<|im_end|>\n", "<\\|im_end|>", "", "\\"]
    turns = spark.createDataFrame([(1, i, r, "x\ny") for i, r in enumerate(roles)],
                                  "conv_id long, turn long, role string, text string")
    row = format_trees(replies_of_turns(turns)).first()
    assert read_turns(row.formatted) == [(r, "x\ny") for r in roles]
