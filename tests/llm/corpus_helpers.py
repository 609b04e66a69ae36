"""A small table with every awkward case, and plain re-statements of rules."""

import re

SCHEMA = "doc_id long, text string, lang string, shard int, cls string, block long, token string, n_chars long"
WORDS = ("the river runs past a quiet mill and turns again towards hills where old stones mark "
         "every border that farmers once drew between their fields before rain took them").split()
BASE = " ".join(WORDS + [w + "s" for w in WORDS] + [w[::-1] for w in WORDS])
NEAR = BASE.replace("quiet", "silent", 1)


def rows():
    """Rows with nulls, empty, blank, long, equal, near-equal and repeated
    texts, a null id, and extra columns with names used inside operators."""
    texts = {
        1: BASE, 2: NEAR, 3: BASE, 4: None, 5: "", 6: " \n\t ", 7: "one two", 8: "one two", 9: "Ünï▁cödé  double  spaces ",
        10: "long " * 30_000, 11: "x" * 20_000, 12: "a b c d e f g", 13: BASE.upper(),
    }
    out = [(i, t, None if i % 3 else "en", i, "c", -i, "tok", None) for i, t in texts.items()]
    return out + [out[1], out[1], (None, "no id here at all", None, 0, None, None, None, None)]


def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def word_sets(text, k):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
