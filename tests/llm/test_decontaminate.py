import random

import numpy as np
from corpus_helpers import empty, rows, table
from ledgerloom.llm.decontaminate import (LADDER, ItemIndex, _signs, common_words, contaminated, drop_contaminated,
                                          find_items, shingle_counts, weighted_similarity, window_prints, words_of)


def _words(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return words_of(raw, np.array([0, len(raw)]))[0]


def _corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    items = {i: " ".join(word() for _ in range(rng.randint(1, 70))) + "." for i in range(60)}
    docs, truth = {}, set()
    for d in range(200):
        body = [word() for _ in range(rng.randint(0, 200))]
        if d % 4 == 0:
            i = rng.randrange(60)
            text = items[i].upper() if d % 8 else items[i].replace(" ", ",  \n")
            at = rng.randint(0, len(body))
            body[at:at] = ["(" + text + ")"]
            truth.add((d, i))
        docs[d] = " ".join(body)
    return items, docs, truth


def test_planted_items_are_found_and_clean_documents_left(spark):
    items, docs, truth = _corpus()
    long = {i for i, t in items.items() if len(t.split()) >= 5}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    for block in (20_000, 7):
        got = {(r.doc_id, r.item_id) for r in contaminated(frame, bench, block_items=block).collect()}
        assert {p for p in got if p[1] in long} == {p for p in truth if p[1] in long}
        assert got >= truth
        kept = {r.doc_id for r in drop_contaminated(frame, bench, block_items=block).collect()}
        assert kept == set(docs) - {d for d, _ in got}


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(8)
    words = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    index = ItemIndex([(k, words[i:i + 19].tobytes()) for k, i in enumerate(range(0, 280, 20))])
    prints = index.sizes[19][0]
    near = np.concatenate([prints ^ np.uint64(1 << a) ^ np.uint64(1 << b) for a, b in rng.integers(0, 64, (30, 2))]
                          + [rng.integers(0, 2 ** 63, 3000, dtype=np.uint64)])
    got = {tuple(p) for p in index.candidates(19, near).tolist()}
    want = {(i, j) for i, x in enumerate(near) for j, y in enumerate(prints) if bin(int(x ^ y)).count("1") <= 3}
    assert got == want and want


def test_windows_equal_the_plain_definition():
    h = _words("to be or not to be that is the question")
    prints = window_prints(_signs(h), 4)
    for i, p in enumerate(prints.tolist()):
        votes = [sum(1 if int(w) >> k & 1 else -1 for w in h[i:i + 4]) for k in range(64)]
        assert p == sum(1 << k for k, v in enumerate(votes) if v > 0)
    assert _words("The  (Question)!").tolist() == _words("the question").tolist() and len(_words("... !! -")) == 0


def test_similarity_counts_repeats():
    a, b = shingle_counts(_words("x " * 9)), shingle_counts(_words("x " * 7))
    assert weighted_similarity(a, b) == 3 / 5 and weighted_similarity({}, {}) == 0.0
    few = shingle_counts(_words("one two"))
    assert weighted_similarity(few, few) == 1.0


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "a b c d e f g"), (3, "a b c d e f g"), (None, "one two")],
                                  "item_id long, text string")
    got = contaminated(table(spark), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(12, 3), (7, None), (8, None)}
    kept = drop_contaminated(table(spark), bench)
    assert kept.columns == table(spark).columns and kept.count() == len(rows()) - 3
    assert contaminated(empty(spark), bench).collect() == [] and contaminated(table(spark), bench.limit(0)).collect() == []
    assert drop_contaminated(table(spark), bench.limit(0)).count() == len(rows())


def _brute_force(item, doc):
    """Greatest similarity of any run of the document's words."""
    counts, best = shingle_counts(item), 0.0
    for begin in range(len(doc)):
        for n in range(max(1, len(item) * 3 // 4 - 2), min(len(doc) - begin, len(item) * 5 // 4 + 2) + 1):
            best = max(best, weighted_similarity(counts, shingle_counts(doc[begin:begin + n])))
    return best


def _edited(rng, item, word):
    out, n = list(item), len(item)
    for _ in range(rng.randint(1, 1 + n // 28)):
        i, how = rng.choice([0, len(out) - 1, rng.randrange(len(out))]), rng.randrange(5)
        if how == 0:
            out[i] = word()
        elif how == 1:
            out.insert(i, word())
        elif how == 2:
            del out[i:i + rng.randint(1, 3)]
        elif how == 3 and n > 36:                          # a block moves to the end
            out = out[i:] + out[:i]
        else:
            out[i:i + 1] = []
    return out


def test_no_allowed_edit_hides_an_item():
    rng = random.Random(11)
    missed = many = 0
    for length, rounds in ((19, 40), (28, 30), (42, 24), (63, 12), (94, 6), (7, 20)):
        for words in (10_000, 40):                         # few different words: repeats inside an item
            word = lambda: f"w{rng.randrange(words)}"  # noqa: E731, B023
            for _ in range(rounds):
                item = [word() for _ in range(length)]
                doc = [word() for _ in range(9)] + _edited(rng, item, word) + [word() for _ in range(9)]
                h, d = _words(" ".join(item)), _words(" ".join(doc))
                raw = np.frombuffer(("zero " + " ".join(doc)).encode(), np.uint8)
                index = ItemIndex([(5, h.tobytes())], similarity=0.8)
                got = find_items(index, raw, np.array([0, 5, len(raw)]), 0.8)
                want = _brute_force(h, d)
                many += want >= 0.8
                missed += (want >= 0.8) != (set(got) == {(1, 0)})
                if got:
                    like, first, n = got[(1, 0)]
                    assert like == want == weighted_similarity(shingle_counts(h), shingle_counts(d[first:first + n]))
    assert many > 60 and not missed


def test_repetitive_items_are_found():
    for item, doc in (("a b " * 20, "x " + "a b " * 17), ("a b c " * 9, "b c " + "a b c " * 8 + "y"), ("x " * 30, "x " * 27)):
        h, raw = _words(item), np.frombuffer(doc.encode(), np.uint8)
        got = find_items(ItemIndex([(1, h.tobytes())], similarity=0.8), raw, np.array([0, len(raw)]), 0.8)
        assert got[(0, 0)][0] == _brute_force(h, _words(doc)) >= 0.8


def test_windows_fit_what_must_be_in_common():
    rng = np.random.default_rng(3)
    for n in (1, 4, 5, 12, 19, 42, 94, 500):
        h = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
        common = common_words(h, 0.8)
        assert common <= n and common_words(h, 1.0) == n
        index = ItemIndex([(1, h.tobytes())], similarity=0.8)
        (size, (_, _, offset, _)), = index.sizes.items()
        assert size in LADDER and all(any(x <= o and o + size <= x + common for o in offset) for x in range(n - common + 1))
