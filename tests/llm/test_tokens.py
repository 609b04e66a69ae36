import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from corpus_helpers import empty, rows, table
from ledgerloom.llm.sentencepiece_codec import CharacterMap, encode_documents, encoding_digests, load_codec
from ledgerloom.llm.token_counts import count_tokens, load_processor, pre_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts():
    rng = random.Random(2)
    alphabet = list("ab the  \n\t▁é日本😀\x00<s></s><0x0A>.,1234 ") + ["  ", "   ", "�", " "]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + [
        "x" * 3000, " " * 500, "日" * 700, "ab" * 900 + " " * 17 + "end  ", "", " "]


def test_ids_decoding_and_counts_equal_the_library(library):
    codec, texts = load_codec(MODEL), odd_texts()
    load_processor(MODEL)
    for text, ids in zip(texts, codec.encode_many(texts)):
        want = library.encode(text)
        assert ids.tolist() == want
        assert codec.decode(want) == library.decode(want)
        assert sum(len(library.encode(p)) if p else 1 for p in pre_tokens(text)) == len(want)


def test_any_ids_decode_as_in_the_library(library):
    rng, codec = random.Random(3), load_codec(MODEL)
    for _ in range(2000):
        ids = [rng.randint(0, 600) for _ in range(rng.randint(0, 8))]
        assert codec.decode(ids) == library.decode(ids)


def test_spans_cover_the_text_in_order():
    codec = load_codec(MODEL)
    for text in odd_texts()[:400]:
        ids = codec.encode(text)
        spans, raw = codec.spans(text, ids), text.encode()
        assert b"".join(raw[a:b] for a, b in spans) == raw
        assert all(a <= b for a, b in spans)


def _map_of(pairs):
    """A compiled map of single-byte-led keys: a double array by brute force."""
    targets, begin = b"", {}
    for key, value in pairs:
        begin[key] = len(targets)
        targets += value + b"\0"
    units = [0] * 4096
    taken, where = {0}, {b"": 0}
    prefixes = sorted({k[:i] for k, _ in pairs for i in range(len(k) + 1)}, key=len)
    free = 256
    for prefix in prefixes:
        node = where[prefix]
        kids = {k[len(prefix)] for k, _ in pairs if k.startswith(prefix) and len(k) > len(prefix)}
        leaf = prefix in begin
        base = free
        free += 512
        offset = node ^ base
        units[node] |= offset << 10 | (256 if leaf else 0)
        if leaf:
            units[base] = begin[prefix] | 1 << 31
        for c in kids:
            units[base ^ c] |= c
            where[prefix + bytes([c])] = base ^ c
    blob = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(blob)) + blob + targets


def test_character_map_takes_the_longest_prefix():
    found = CharacterMap(_map_of([(b"a", b"x"), (b"abc", b"yz"), (b"q", b"")]))
    assert [found.longest_prefix(t, 0) and (found.longest_prefix(t, 0)[0],
            found.replacement(found.longest_prefix(t, 0)[1])) for t in (b"a", b"ab", b"abcd", b"q", b"b")] == [
        (1, b"x"), (1, b"x"), (3, b"yz"), (1, b""), None]


def test_normalising_records_the_source_of_every_byte():
    codec = load_codec(MODEL)
    mapped = object.__new__(type(codec))
    mapped.__dict__ = dict(codec.__dict__, map=CharacterMap(_map_of([(b"a", b"xx"), (b"abc", b"y ")])))
    text, source = mapped.normalise("abcda")
    assert text == "▁y▁dxx" and source.tolist() == [0, 0, 0, 0, 0, 0, 0, 3, 4, 4, 5]


def test_tables(spark, library):
    text = {r[0]: r[1] or "" for r in rows()}
    counts = count_tokens(table(spark), MODEL, cells=16, block_bytes=40_000).collect()
    assert sorted(map(str, (r.doc_id for r in counts))) == sorted(str(r[0]) for r in rows())
    for r in counts:
        assert (r.n_bytes, r.n_tokens) == (len(text[r.doc_id].encode()), len(library.encode(text[r.doc_id])))
        assert r.over_limit == (r.n_tokens > 4096)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    encoded = encoding_digests(table(spark), MODEL).collect()
    assert len(encoded) == len(rows())
    for r in encoded:
        ids = library.encode(text[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


def test_registered_query_digests_the_spans(spark):
    from ledgerloom.llm.queries import QUERIES
    codec, sf = load_codec(MODEL), "/root/testdata/sf0.001"
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op4_sentencepiece_codec"](spark, sf).limit(20).collect():
        spans = codec.spans(text[r.doc_id], codec.encode(text[r.doc_id])).T.tolist()
        want = ";".join(",".join(map(str, side)) for side in spans)
        assert r.spans_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_many_documents_share_frequent_words(spark, library):
    docs = spark.createDataFrame([(i, f"the cat number {i} the end") for i in range(300)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, MODEL, cells=8).collect()}
    assert got == {i: len(library.encode(f"the cat number {i} the end")) for i in range(300)}


def test_empty_tables(spark):
    assert count_tokens(empty(spark), MODEL).collect() == []
    assert encode_documents(empty(spark), MODEL).collect() == []
