"""SentencePiece byte-pair encoding with offsets, and decoding.

The model file is read here, and normalisation, merging and decoding are done
here, so every piece can be projected to the bytes of the original text:

* normalisation walks the text by the longest prefix found in the compiled
  character map (a double-array trie), records for each normalised byte the
  original byte it came from, escapes spaces and adds the dummy leading space;
* a space run with the characters up to the next one is encoded on its own (no
  piece has a space behind another character), by merging the adjacent pair
  with the best score, leftmost first; unknown characters become byte pieces;
* decoding joins pieces and byte runs, turns invalid bytes into U+FFFD, and
  drops the dummy leading space.

Encoded pre-tokens are remembered per worker, up to ``MEMO`` of them.

Defined results: null or empty text gives no ids and the empty text back;
repeated rows are encoded each; very long texts are encoded whole; an empty
table gives an empty result; other columns stay out of the plan.
"""

from __future__ import annotations

import hashlib
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, pick, prepare, texts_of

SPACE = "▁"
#: Pre-tokens remembered by a worker; beyond it the memory starts anew.
MEMO = 400_000
#: Piece types of the model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Ranks and symbols that stand for nothing to merge.
NO_PAIR, UNSEEN, END = np.int32(2**31 - 1), -1, -2
_RUN = re.compile(SPACE + "*[^" + SPACE + "]+|" + SPACE + "+")


class CharacterMap:
    """The compiled map: trie size, double-array units, replacement strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.targets = blob[4 + size:]

    def longest_prefix(self, data: bytes, start: int) -> tuple[int, int] | None:
        """Length of the longest mapped prefix at ``start`` and where its
        replacement begins; None if no prefix is mapped."""
        if not self.units:
            return None
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for at in range(start, len(data)):
            node ^= data[at]
            if node >= len(units) or (units[node] & 0x800000FF) != data[at]:
                break
            unit = units[node]
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit & 256:
                found = (at - start + 1, units[node] & 0x7FFFFFFF)
        return found

    def replacement(self, begin: int) -> bytes:
        return self.targets[begin:self.targets.index(b"\0", begin)]


class Codec:
    """One model: ``encode``, ``spans`` and ``decode``."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2 as format
        with open(model_file, "rb") as f:
            model = format.ModelProto.FromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        types = {p.type for p in model.pieces}
        if spec.model_type != spec.BPE or types & {USER_DEFINED, UNUSED} or spec.treat_whitespace_as_suffix \
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not spec.byte_fallback:
            raise ValueError("only byte-fallback BPE models that keep and escape spaces are supported")
        self.map = CharacterMap(norm.precompiled_charsmap)
        self.dummy = norm.add_dummy_prefix
        self.pieces = [p.piece for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pre-tokens are not independent: a piece has a space inside")
        self.byte_ids = [0] * 256
        surface: list[bytes] = []
        lengths = []
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == UNKNOWN), -1)
        self.is_byte = [p.type == BYTE for p in model.pieces]
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                surface.append(bytes([value]))
                lengths.append(1)
            elif p.type == CONTROL:
                surface.append(b"")
                lengths.append(0)
            elif p.type == UNKNOWN:
                surface.append(spec.unk_surface.encode())
                lengths.append(0)
            else:
                surface.append(p.piece.replace(SPACE, " ").encode())
                lengths.append(len(p.piece.encode()))
        self.surface = surface
        self.lengths = np.array(lengths, np.int64)      # in normalised bytes
        self.names = list(map(str, range(len(surface))))
        self._pair_table()
        self.memo: dict[str, bytes] = {}

    # normalisation -------------------------------------------------------
    def normalise(self, text: str) -> tuple[str, np.ndarray | None]:
        """The normalised text, and for each of its bytes and the end the
        original byte it came from (None: computed by ``spans`` directly)."""
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.map.units:
            return (SPACE if self.dummy else "") + text.replace(" ", SPACE), None
        data, out, source = text.encode(), [], []
        mark = SPACE.encode()
        if self.dummy:
            out.append(mark)
            source += [0] * len(mark)
        at = 0
        while at < len(data):
            hit = self.map.longest_prefix(data, at)
            if hit:
                length, piece = hit[0], self.map.replacement(hit[1])
            else:
                lead = data[at]
                length = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                piece = data[at:at + length]
            piece = piece.replace(b" ", mark)
            out.append(piece)
            source += [at] * len(piece)
            at += length
        source.append(len(data))
        return b"".join(out).decode(), np.array(source, np.int64)

    # encoding ------------------------------------------------------------
    def _pair_table(self) -> None:
        """Every mergeable pair of symbols, sorted by key; single characters
        that are no piece get symbol numbers behind the pieces."""
        number = dict(self.ids)
        for piece in self.ids:
            for c in piece:
                number.setdefault(c, len(self.pieces) + len(number))
        self.span = max(number.values(), default=0) + 2
        self.symbol_of = np.full(0x110000, UNSEEN, np.int32)
        for c, i in number.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        left, right, into = [], [], []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = number.get(piece[:cut]), number.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    into.append(i)
        keys = np.array(left, np.int64) * self.span + np.array(right, np.int64)
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.int64(1) << 62)
        self.pair_into = np.append(np.array(into, np.int32)[order], -1)
        by_score = np.array([self.scores.get(p, -np.inf) for p in self.pieces])
        self.rank = np.append(np.unique(-by_score, return_inverse=True)[1].astype(np.int32), NO_PAIR)

    def _into(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair merges into, or -1."""
        key = a.astype(np.int64) * self.span + b
        at = np.searchsorted(self.pair_keys, key)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_into[at], -1)

    def merge_many(self, runs: list[str]) -> list[bytes]:
        """Ids (int32 bytes) of many pre-tokens, merged side by side: every
        round merges the best pair, leftmost first, of each row."""
        out: list[bytes] = [b""] * len(runs)
        by_width: dict[int, list[int]] = {}
        for i, run in enumerate(runs):
            n = len(run)
            by_width.setdefault(8 if n <= 8 else 16 if n <= 16 else 32 if n <= 32 else 0, []).append(i)
        for i in by_width.pop(0, []):
            out[i] = np.array(self.merge_long(runs[i]), np.int32).tobytes()
        for width, rows in by_width.items():
            for start in range(0, len(rows), 20_000):
                some = rows[start:start + 20_000]
                codes = np.frombuffer("".join([runs[i] for i in some]).encode("utf-32-le"), np.uint32)
                sizes = np.array([len(runs[i]) for i in some])
                symbols = np.full((len(some), width + 1), END, np.int32)
                symbols[np.arange(width + 1) < sizes[:, None]] = self.symbol_of[codes]
                self._merge_rows(symbols)
                live = symbols != END
                packed, offsets = symbols[live].tobytes(), [0, *np.cumsum(4 * live.sum(axis=1)).tolist()]
                for k, i in enumerate(some):
                    out[i] = packed[offsets[k]:offsets[k + 1]]
                # characters that are no piece
                for k in np.flatnonzero(((symbols == UNSEEN) | (symbols >= len(self.pieces))).any(axis=1)).tolist():
                    i = some[k]
                    out[i] = np.array(self._with_bytes(runs[i], symbols[k][live[k]].tolist()), np.int32).tobytes()
        return out

    def _merge_rows(self, symbols: np.ndarray) -> None:
        width = symbols.shape[1]
        live = np.arange(len(symbols))
        rows = symbols.copy()
        ranks = self.rank[self._into(rows[:, :-1], rows[:, 1:])]
        columns = np.arange(width)
        while len(live):
            at = ranks.argmin(axis=1)
            go = ranks[np.arange(len(live)), at] != NO_PAIR
            if not go.all():
                symbols[live[~go]] = rows[~go]
                live, rows, ranks, at = live[go], rows[go], ranks[go], at[go]
                if not len(live):
                    break
            each = np.arange(len(live))
            merged = self._into(rows[each, at], rows[each, at + 1])
            shifted = np.concatenate([rows[:, 1:], np.full((len(live), 1), END, np.int32)], axis=1)
            rows = np.where(columns > at[:, None], shifted, rows)
            rows[each, at] = merged
            moved = np.concatenate([ranks[:, 1:], np.full((len(live), 1), NO_PAIR, np.int32)], axis=1)
            ranks = np.where(columns[:-1] > at[:, None], moved, ranks)
            inner = at + 1 < width
            ranks[each[inner], at[inner]] = self.rank[self._into(merged[inner], rows[each[inner], at[inner] + 1])]
            behind = at > 0
            ranks[each[behind], at[behind] - 1] = self.rank[
                self._into(rows[each[behind], at[behind] - 1], merged[behind])]

    def _with_bytes(self, run: str, symbols: list[int]) -> list[int]:
        out, at = [], 0
        for s in symbols:
            if 0 <= s < len(self.pieces):
                out.append(s)
                at += len(self.pieces[s])
            else:
                out += [self.byte_ids[b] for b in run[at].encode()]
                at += 1
        return out

    def merge_long(self, run: str) -> list[int]:
        """``merge`` for long pre-tokens: a heap of pairs over a linked list."""
        import heapq
        scores, n = self.scores, len(run)
        symbol: list[str | None] = list(run)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(-s, i, 2) for i in range(n - 1) if (s := scores.get(run[i:i + 2])) is not None]
        heapq.heapify(heap)

        def offer(a: int, b: int) -> None:
            pair = symbol[a] + symbol[b]
            if (s := scores.get(pair)) is not None:
                heapq.heappush(heap, (-s, a, len(pair)))

        while heap:
            _, a, size = heapq.heappop(heap)
            b = right[a]
            if symbol[a] is None or b < 0 or len(symbol[a]) + len(symbol[b]) != size:
                continue
            symbol[a] += symbol[b]
            symbol[b] = None
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
                offer(a, right[a])
            if left[a] >= 0:
                offer(left[a], a)
        out = []
        for s in symbol:
            if s is not None:
                i = self.ids.get(s)
                out += [i] if i is not None else [self.byte_ids[x] for x in s.encode()]
        return out

    def runs(self, text: str) -> list[str]:
        """The independent pre-tokens of a text, spaces escaped."""
        normal = self.normalise(text)[0]
        if SPACE + SPACE not in normal and normal[:1] == SPACE:
            return [SPACE + w for w in normal.split(SPACE)[1:]]
        return _RUN.findall(normal)

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every whole text."""
        cut = [self.runs(t) for t in texts]
        new = list({r for runs in cut for r in runs} - self.memo.keys())
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = list({r for runs in cut for r in runs})
        memo = self.memo
        memo.update(zip(new, self.merge_many(new)))
        out = [np.frombuffer(b"".join([memo[r] for r in runs]), np.int32) for runs in cut]
        for r in new:
            if len(r) > 64:
                del memo[r]
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of one whole text."""
        return self.encode_many([text])[0]

    def spans(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Begin and end byte of every piece in the original UTF-8 text (n, 2).
        A piece with the dummy leading space begins where the text begins."""
        ends = np.cumsum(self.lengths[ids])
        begins = ends - self.lengths[ids]
        source = self.normalise(text)[1] if self.map.units else None
        if source is None:
            data = np.frombuffer(text.encode(), np.uint8)
            wide = np.where(data == 32, len(SPACE.encode()), 1)
            lead = len(SPACE.encode()) if self.dummy and text else 0
            source = np.append(np.concatenate([np.zeros(lead, np.int64), np.repeat(np.arange(len(data)), wide)]),
                               len(data))
        return np.stack([source[begins], source[ends]], axis=1)

    # decoding ------------------------------------------------------------
    def decode(self, ids) -> str:
        """The text of the ids."""
        ids = [int(i) for i in ids]
        out = b"".join(map(self.surface.__getitem__, ids))
        if self.dummy and ids:
            first = next((i for i in ids if self.surface[i] or not self.is_byte[i]), None)
            lead = next((i for i in ids if self.surface[i]), None)
            if lead is not None and first is not None and self.surface[lead][:1] == b" " and not self.is_byte[lead] and lead != self.unknown:
                out = out[1:]
        try:
            return out.decode()
        except UnicodeDecodeError:
            return "".join(self._repair(ids))

    def _repair(self, ids: list[int]):
        """Byte runs that are no UTF-8 give one U+FFFD per invalid byte."""
        pending, seen = b"", False
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                pending += self.surface[i]
                continue
            while pending:
                for size in (1, 2, 3, 4):
                    try:
                        yield pending[:size].decode()
                    except UnicodeDecodeError:
                        continue
                    pending = pending[size:]
                    break
                else:
                    yield "�"
                    pending = pending[1:]
                seen = True
            if i is not None:
                piece = self.surface[i].decode()
                yield piece[1:] if self.dummy and not seen and i != self.unknown and piece[:1] == " " else piece
                seen = seen or bool(piece)


@lru_cache(maxsize=2)
def load_codec(model_file: str) -> Codec:
    return Codec(model_file)


def _encoded(codec: Codec, batches, limit: int = 2 << 20):
    """(doc_ids, texts, ids of each text) of every run of rows."""
    for batch in batches:
        for part in byte_slices(batch, "text", limit):
            texts = texts_of(part, "text")
            yield part.column("doc_id"), texts, codec.encode_many(texts)


def _encode_batches(model_file: str, with_spans: bool):
    def run(batches):
        codec = load_codec(model_file)
        for doc_ids, texts, ids in _encoded(codec, batches):
            offsets = pa.array(np.cumsum([0, *map(len, ids)]).astype(np.int32))
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            columns = [doc_ids, pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))]
            names = ["doc_id", "ids"]
            if with_spans:
                spans = [codec.spans(t, i) for t, i in zip(texts, ids)]
                both = np.concatenate(spans) if spans else np.zeros((0, 2), np.int64)
                for k, name in enumerate(("begins", "ends")):
                    columns.append(pa.ListArray.from_arrays(
                        offsets, pa.array(both[:, k].astype(np.int32), pa.int32())))
                    names.append(name)
            columns.append(pa.array([codec.decode(i.tolist()) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*names, "decoded"])
    return run


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _digest_batches(model_file: str):
    def run(batches):
        codec = load_codec(model_file)
        for doc_ids, texts, ids in _encoded(codec, batches):
            rows = []
            for text, found in zip(texts, ids):
                numbers = found.tolist()
                # a piece ends where the next one begins
                spans = codec.spans(text, found)
                places = [*spans[:1, 0].tolist(), *spans[:, 1].tolist()]
                short = not places or places[-1] < len(codec.names)
                bounds = list(map(codec.names.__getitem__ if short else str, places))
                rows.append((len(numbers), _hex(",".join(map(codec.names.__getitem__, numbers))),
                             _hex(codec.decode(numbers)),
                             _hex(",".join(bounds[:-1]) + ";" + ",".join(bounds[1:]))))
            n, *digests = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(n, pa.int64()), *[pa.array(d, pa.string()) for d in digests]],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])
    return run


def encode_documents(docs: DataFrame, model_file: str, spans: bool = True,
                     doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids, (begins, ends: each piece's bytes of the original text),
    decoded (the text that the ids give back) of every row."""
    prepare(docs.sparkSession)
    extra = "begins array<int>, ends array<int>, " if spans else ""
    return pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        _encode_batches(model_file, spans), f"doc_id long, ids array<int>, {extra}decoded string")


def encoding_digests(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas),
    decoded_sha256 and spans_sha256 (the pieces' first bytes joined by commas,
    a semicolon, their end bytes) of every row's encoding.  The digests are
    taken where the ids are made, so no list of ids crosses to the JVM."""
    prepare(docs.sparkSession)
    return pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        _digest_batches(model_file),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
