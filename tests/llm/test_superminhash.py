import random

import numpy as np
from corpus_helpers import empty, rows, table, word_sets
from ledgerloom.llm.components import components
from ledgerloom.llm.shingles import shingle_sets
from ledgerloom.llm.superminhash import near_duplicates, one_of_each, signatures


def brute_force(texts, k, percent=80):
    sets = {i: word_sets(t, k) for i, t in texts.items()}
    up = {i: i for i in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * either:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_sets_and_their_sizes():
    texts = [r[1] or "" for r in rows()]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    for k in (4, 5):
        _, ends = shingle_sets(raw, at, k)
        assert np.diff(ends).tolist() == [len(word_sets(t, k)) for t in texts]


def test_signatures_estimate_without_bias_and_below_minhash_variance():
    rng, errors = np.random.default_rng(5), []
    for _ in range(150):
        common, a, b = (rng.integers(0, 2 ** 63, n, dtype=np.uint64) for n in (40, 10, 10))
        x, y = np.unique(np.append(common, a)), np.unique(np.append(common, b))
        s = signatures(np.append(x, y), np.array([0, len(x), len(x) + len(y)]))
        errors.append((s[0] == s[1]).mean() - 40 / 60)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < 0.9 * (2 / 3 * 1 / 3 / 128) ** 0.5


def test_rank_slots_are_permutations():
    s = signatures(np.array([77], np.uint64), np.array([0, 1]))[0]
    assert sorted(np.floor(s).astype(int)) == list(range(128))
    assert np.isinf(signatures(np.zeros(0, np.uint64), np.array([0, 0]))).all()


def chain_texts():
    """Chains whose ends are not alike, large near groups, shared passages."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts, n = {}, 0
    for _ in range(6):                      # chains: each step replaces a few words
        now = [word() for _ in range(120)]
        for _ in range(12):
            texts[n] = " ".join(now)
            n += 1
            at = rng.randrange(0, 110)
            now = now[:at] + [word() for _ in range(7)] + now[at + 7:]
    base = [word() for _ in range(100)]
    for _ in range(60):                     # one large group around a text
        at = rng.randrange(100)
        texts[n] = " ".join(base[:at] + [word()] + base[at + 1:])
        n += 1
    passage = " ".join(word() for _ in range(60))
    for _ in range(40):                     # a passage in otherwise different texts
        texts[n] = passage + " " + " ".join(word() for _ in range(rng.randrange(10, 60)))
        n += 1
    for _ in range(80):
        texts[n] = " ".join(word() for _ in range(rng.randrange(1, 60)))
        n += 1
    return texts


def test_groups_equal_brute_force(spark):
    texts = chain_texts()
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    for k in (4, 5):
        want = brute_force(texts, k)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame, words=k).collect()}
        assert got == want
    kept = {r.doc_id for r in one_of_each(frame).collect()}
    assert kept == {i for i, (_, c) in brute_force(texts, 5).items() if c == i}


def test_awkward_rows(spark):
    texts = {r[0]: r[1] for r in rows() if r[0] is not None}
    want = brute_force(texts, 4)
    got = near_duplicates(table(spark), words=4).collect()
    assert len(got) == len(rows())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.component_id == r.doc_id)
    assert near_duplicates(empty(spark)).collect() == []
    frame = one_of_each(table(spark))
    assert frame.columns == table(spark).columns
    assert sorted(str(r.doc_id) for r in frame.collect()) == sorted(map(str, [1, 4, 5, 6, 7, 9, 10, 11, 12, None]))


def test_repeated_ids_with_different_texts_stay_apart(spark):
    frame = spark.createDataFrame([(1, "a b c d e f g h"), (1, "p q r s t u v w"), (2, "p q r s t u v w")],
                                  "doc_id long, text string")
    assert sorted(r.text for r in one_of_each(frame).collect()) == ["a b c d e f g h", "p q r s t u v w"]


def test_rows_without_words_stay_whatever_else_is_repeated(spark):
    bare = [(4, None), (4, None), (5, ""), (5, ""), (None, " "), (None, " ")]
    for worded in ([(1, "a b c d e f g h")], [(1, "a b c d e f g h")] * 2):
        frame = spark.createDataFrame(bare + worded, "doc_id long, text string")
        got = sorted((str(r.doc_id), str(r.text)) for r in one_of_each(frame).collect())
        assert got == sorted((str(i), str(t)) for i, t in bare + worded[:1])


def test_components_of_long_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001)]
    random.Random(1).shuffle(links)
    frame = spark.createDataFrame(links, "a long, b long").repartition(6)
    got = {r.vertex: r.root for r in components(frame).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}, 5001: 5000}
    assert components(frame.limit(0)).collect() == []


def test_one_of_each_beside_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, "")],
                                 "doc_id long, text string").selectExpr(
        "*", "1 AS _keep_id", "2 AS _keep_key", "true AS _keep_worded")
    got = one_of_each(docs)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [1, 3]
    assert sorted(r.doc_id for r in one_of_each(docs.where("doc_id > 1")).collect()) == [2, 3]
