"""Prefix-DP byte-pair encoding equals the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from corpus_helpers import empty, rows, table
from tokenizers import Tokenizer

from ledgerloom.llm.word_bpe import WordBpe, encode_documents, encoding_digests

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def model():
    return WordBpe(FILE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def same(model, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert model.encode(text) == ids, text[:80]
    assert model.decode(ids) == library.decode(ids, skip_special_tokens=False)


def merged(model, token_of, a, b):
    """Plain byte-pair merging of two tokens' symbols."""
    def leaves(t):
        return [t] if t not in model.parts else leaves(model.parts[t][0]) + leaves(model.parts[t][1])
    out = leaves(a) + leaves(b)
    while True:
        best = min(((model.rank[p], i) for i, p in enumerate(zip(out, out[1:])) if p in model.rank), default=None)
        if best is None:
            return out
        i = best[1]
        out[i:i + 2] = [token_of[out[i], out[i + 1]]]


def test_pair_test_equals_plain_merging(model):
    rng = random.Random(3)
    inner = [t for t in model.size if not model.ends_word[t]]
    every, token_of = list(model.size), {p: t for t, p in model.parts.items()}
    for _ in range(4000):
        a, b = rng.choice(inner), rng.choice(every)
        if model.reachable(a) and model.reachable(b):
            assert model.compatible(a, b) == (merged(model, token_of, a, b) == [a, b]), (model.surface[a], model.surface[b])


def test_awkward_texts(model, library):
    for text in ["", " ", "\n\t", "Hello, World! it's they'RE we'll I'D", "a" * 5000, "ab" * 3000, "x" * 20_000,
                 "<|endoftext|> tail <|startoftext|>", "x<|endoftext|>y", "<|END", "Ünï▁cödé  double　spaces",
                 "ΑΣ ΣΑΣ ς", "İstanbul ẞ ﬁ", "é å", "12 345 ½ ²", "日本語 한국어 ภาษา", "👍🏽 👨‍👩‍👧", "\u0000\u0007\x1c\x1f",
                 "can''t ''s !!'s 's", "�﻿", "mixed" + "ß" * 300 + "end", "</w> a</w>b"]:
        same(model, library, text)


def test_every_character(model, library):
    chars = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    import unicodedata
    chars = [c for c in chars if unicodedata.category(c) != "Cn"]        # assigned ones
    texts = [f"a{c}b {c}" for c in chars]
    theirs = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    ours = model.encode_many(texts)
    assert [c for c, x, y in zip(chars, theirs, ours) if np.frombuffer(y, "<u4").tolist() != x] == []


def test_random_words(model, library):
    rng = random.Random(1)
    letters = "aabcdeeéghiilmnoorsstuuxßñ0'!.-"
    for _ in range(2000):
        same(model, library, "".join(rng.choice(letters) for _ in range(rng.randint(1, 60))))


def test_given_documents(spark, model, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in encoding_digests(encode_documents(docs, FILE)).collect()}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        out = library.decode(ids, skip_special_tokens=False)
        assert tuple(got[r.doc_id])[1:] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                            hashlib.sha256(out.encode()).hexdigest())


def test_awkward_table(spark, library):
    got = encode_documents(table(spark), FILE).collect()
    want = sorted(((r[0] if r[0] is not None else -1), library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows())
    assert sorted(((r.doc_id if r.doc_id is not None else -1), np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    assert encoding_digests(encode_documents(empty(spark), FILE)).collect() == []
