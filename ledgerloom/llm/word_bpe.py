"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is exactly one token that its encoding ends
with.  An automaton over the vocabulary (suffix links lead from each state to
the next shorter token that ends there) gives the tokens that end at each
position; such a token is the last one of the prefix if it is compatible with
the last token of the prefix before it, that is, if merging the two tokens'
symbols gives the two tokens again.  The tokens are then read off backwards.
Work is linear in the word's length, whatever the length.

Two tokens are incompatible if some merge crosses their boundary: a part on
the right edge of the first and a part on the left edge of the second form a
pair whose rank comes before both parts are merged into something larger (of
equal ranks the leftmost goes first).

The text's path is that of the model file: special strings stand for
themselves, the rest is composed (NFC), runs of white space become one space,
upper case becomes lower case letter by letter, and words, contractions,
single digits and runs of other signs are the words; a word's last symbol
carries the mark of the word's end.  Encoded words are remembered per worker,
up to ``MEMO`` of them.

Defined results: null or empty text gives no ids and the empty text back;
repeated rows are encoded each; very long texts are encoded whole; an empty
table gives an empty result; other columns stay out of the plan.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, pick, prepare, texts_of

#: Words remembered by a worker; beyond it the memory starts anew.
MEMO = 400_000
#: Stands for the end of a word inside the automaton (no symbol of the model).
END = chr(0xE000)
NEVER = 1 << 40
# --- fixed values: the model's white space and its byte alphabet ------------
SPACES = r"\t\n\x0b\x0c\r\x20\x85\xa0  -     　"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: its own if it can be printed,
    else the next one from U+0100 on."""
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in set(PRINTABLE) else chr(next(spare)) for b in range(256)]


class WordBpe:
    """One model file: ``encode`` and ``decode``."""

    def __init__(self, model_file: str):
        import ahocorasick
        with open(model_file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not suffix or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] \
                or any(model.get(k) for k in ("unk_token", "dropout", "continuing_subword_prefix", "byte_fallback",
                                              "ignore_merges")):
            raise ValueError("only lower-casing BPE models with word ends and without unknowns are supported")
        vocab, self.surface = model["vocab"], {}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}      # of a pair
        self.parts = {vocab[a + b]: (vocab[a], vocab[b]) for a, b in pairs}
        self.made = {vocab[a + b]: r for r, (a, b) in enumerate(pairs)}              # rank that makes a token
        self.size: dict[int, int] = {}                                               # in symbols
        self.ends_word: dict[int, bool] = {}
        spelling: dict[int, str] = {}
        for text, i in vocab.items():
            if i not in self.parts:
                self.size[i], self.ends_word[i] = 1, text != text[0] and text.endswith(suffix)
                spelling[i] = text[0] + (END if self.ends_word[i] else "")
            self.surface[i] = text
        for a, b in pairs:
            a, b, i = vocab[a], vocab[b], vocab[a + b]
            self.size[i], self.ends_word[i] = self.size[a] + self.size[b], self.ends_word[b]
            spelling[i] = spelling[a] + spelling[b]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, text in spelling.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.special.items():
            self.surface[i] = text
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word = regex.compile(pattern.replace(r"\s", SPACES))
        self.gap = regex.compile(f"[{SPACES}]+")
        self.letters = {b: c for b, c in enumerate(byte_alphabet())}
        self.fits: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}

    # the test of neighbours ------------------------------------------------
    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(part, rank at which it is merged further) along one edge of a
        token, the token itself first."""
        out, merged = [], NEVER
        while True:
            out.append((token, merged))
            if token not in self.parts:
                return out
            merged = self.made[token]
            token = self.parts[token][side]

    def _crossing(self, a: int, b: int, own: bool) -> bool:
        """Is there a merge over the boundary of ``a`` and ``b``?  ``own``
        leaves out the merge of the two themselves."""
        for left, left_until in self._edge(a, 1):
            for right, right_until in self._edge(b, 0):
                r = self.rank.get((left, right))
                if r is not None and r < left_until and r <= right_until \
                        and r > self.made.get(left, -1) and r > self.made.get(right, -1) \
                        and not (own and left == a and right == b):
                    return True
        return False

    def compatible(self, a: int, b: int) -> bool:
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) > 4_000_000:
                self.fits.clear()
            known = self.fits[a, b] = not self._crossing(a, b, False)
        return known

    def reachable(self, token: int) -> bool:
        """Do the token's own symbols merge to the token?"""
        known = self.whole.get(token)
        if known is None:
            parts = self.parts.get(token)
            known = self.whole[token] = parts is None or (
                all(map(self.reachable, parts)) and not self._crossing(*parts, True))
        return known

    # encoding --------------------------------------------------------------
    def encode_word(self, word: str) -> list[int]:
        """Ids of one word."""
        symbols = "".join([self.letters[b] for b in word.encode()])
        n = len(symbols)
        last = [-1] * (n + 1)
        size, ends_word, compatible = self.size, self.ends_word, self.compatible
        for end, token in self.automaton.iter(symbols + END):
            at = end if end == n else end + 1
            if last[at] >= 0 or (at == n) != ends_word[token]:
                continue
            before = at - size[token]
            if before == 0:
                if self.reachable(token):
                    last[at] = token
            elif last[before] >= 0 and self.reachable(token) and compatible(last[before], token):
                last[at] = token
        out, at = [], n
        while at:
            out.append(last[at])
            at -= size[last[at]]
        return out[::-1]

    def words(self, text: str) -> list[str]:
        """The words of a text without special strings."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = self.gap.sub(" ", text)
        # letter by letter: no special form of sigma at a word's end
        return self.word.findall(text.replace("Σ", "σ").lower())

    def pieces(self, text: str) -> list[str | int]:
        """Words (str) and special tokens (int) of a text."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.words(text)
        out: list[str | int] = []
        for part in self.cut.split(text):
            out += [self.special[part]] if part in self.special else self.words(part)
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of every whole text, as little-endian unsigned 32-bit numbers."""
        cut = [self.pieces(t) for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo, long = self.memo, []
        for w in {w for pieces in cut for w in pieces} - memo.keys():
            memo[w] = np.array(self.encode_word(w) if isinstance(w, str) else [w], "<u4").tobytes()
            if isinstance(w, str) and len(w) > 64:
                long.append(w)
        out = [b"".join([memo[w] for w in pieces]) for pieces in cut]
        for w in long:
            del memo[w]
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_many([text])[0], "<u4").tolist()

    # decoding --------------------------------------------------------------
    def decode(self, ids) -> str:
        """The text of the ids: their surfaces, one space between (the model
        has no decoder of its own)."""
        return " ".join([self.surface[i] for i in ids])


@lru_cache(maxsize=2)
def load_model(model_file: str) -> WordBpe:
    return WordBpe(model_file)


def _encode_batches(model_file: str):
    def run(batches):
        model = load_model(model_file)
        for batch in batches:
            for part in byte_slices(batch, "text", 4 << 20):
                ids = model.encode_many(texts_of(part, "text"))
                decoded = [model.decode(np.frombuffer(i, "<u4").tolist()) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "decoded"])
    return run


def encode_documents(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit numbers, packed), decoded
    (the text that the ids give back) of every row."""
    prepare(docs.sparkSession)
    return pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        _encode_batches(model_file), "doc_id long, ids binary, decoded string")


def encoding_digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the packed ids) and decoded_sha256."""
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
