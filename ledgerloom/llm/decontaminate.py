"""Benchmark decontamination by SimHash of item-sized windows.

A benchmark item is in a document if a run of the document's words, of any
length, has an exact weighted shingle similarity (sum of minima over sum of
maxima of the counts of five-word shingles) of 0.8 or more with it.

* Window size: from 0.8 follows how many words in a row, at least, such a run
  and the item have in common (``common_words``).  An item gets the largest
  window size of the ladder within that, at steps that leave one whole window
  inside any such stretch, so no edit that 0.8 allows can hide the item.
* SimHash: each word adds +1 or -1 to 64 counters by the bits of its hash; a
  window's fingerprint has the signs.  Windows slide by prefix sums, over the
  documents at every word for every size in use.
* Multi-index: a fingerprint is cut into ``radius`` + 1 blocks.  Two prints
  within ``radius`` bits agree in one block at least, so looking each block up
  in its own table finds every pair within the radius; the distance of those
  is then computed.
* Around a candidate, the number of words that begin any item's shingle bounds
  the similarity; where that allows it, the best run is searched exactly.

The documents are read once per block of ``block_items`` benchmark items, so
what is sent to the tasks has a fixed bound however large the benchmark is.

Defined results: words are runs of letters, digits and other non-space
characters, lower-cased, with punctuation at their ends removed; null and
empty texts match nothing; an item without words matches nothing; an item of
fewer than five words is one shingle; repeated rows are reported each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, mix64, pick, prepare, utf8_buffer

WORDS, RADIUS = 5, 3
#: Sizes of windows in words: a ladder of ratio about 1.5 (fixed by rule).
LADDER = [1, 2, 3]
while LADDER[-1] < 100_000:
    LADDER.append(LADDER[-1] * 3 // 2)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    byte = np.arange(256, dtype=np.uint64)
    byte[65:91] += np.uint64(32)
    value = mix64((byte + np.uint64(3)) * _STEP)
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True
    plain = np.zeros(256, bool)                       # letters, digits and non-ASCII bytes
    plain[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    value[space] = 0
    return value, space, plain


_VALUE, _SPACE, _PLAIN = _tables()


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes in order, the rows+1 offsets into them, and the byte at
    which each word's run begins.  Runs without any plain byte are no words."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
    space = _SPACE[raw]
    start = ~space
    start[1:] &= space[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    start[edges] = ~space[edges]
    starts = np.flatnonzero(start)
    # first and last plain byte of every run
    plain = np.flatnonzero(_PLAIN[raw])
    first = np.searchsorted(plain, starts)
    after = np.searchsorted(plain, np.append(starts[1:], n))
    has = after > first
    starts, first, after = starts[has], first[has], after[has]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), starts
    begin, end = plain[first], plain[after - 1] + 1
    power = np.cumprod(np.full(int((end - begin).max()), _STEP, np.uint64))
    lengths = end - begin
    stops = np.cumsum(lengths)
    inside = np.arange(int(stops[-1])) - np.repeat(stops - lengths, lengths)
    sums = np.add.reduceat(_VALUE[raw[np.repeat(begin, lengths) + inside]] * power[inside], stops - lengths)
    return mix64(sums), np.searchsorted(starts, offsets), starts


def _signs(h: np.ndarray) -> np.ndarray:
    """Prefix sums of the words' +1/-1 votes (n + 1 x 64)."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little")
    # running sums row by row over all blocks of 64 rows at once, then by block
    n = len(h)
    blocks = np.zeros((n // 64 + 1, 64, 64), np.int32)
    votes = blocks.reshape(-1, 64)
    votes[1:n + 1] = bits
    votes[1:n + 1] *= 2
    votes[1:n + 1] -= 1
    for row in range(1, 64):
        blocks[:, row] += blocks[:, row - 1]
    blocks[1:] += np.cumsum(blocks[:-1, -1], axis=0)[:, None]
    return votes[:n + 1]


def window_prints(votes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the ``size`` words from every position."""
    if len(votes) <= size:
        return np.zeros(0, np.uint64)
    return np.packbits(votes[size:] > votes[:-size], axis=1, bitorder="little").view("<u8").reshape(-1)


def shingle_counts(h: np.ndarray, words: int = WORDS) -> dict[bytes, int]:
    """Counts of the word shingles of a run of word hashes."""
    out: dict[bytes, int] = {}
    width = min(words, len(h))
    raw = h.tobytes()
    for i in range(len(h) - width + 1 if width else 0):
        key = raw[8 * i:8 * (i + width)]
        out[key] = out.get(key, 0) + 1
    return out


def weighted_similarity(a: dict, b: dict) -> float:
    least = sum(min(n, b.get(k, 0)) for k, n in a.items())
    most = sum(a.values()) + sum(b.values()) - least
    return least / most if most else 0.0


def common_words(h: np.ndarray, similarity: float) -> int:
    """The least length of the longest stretch of words that an item shares
    with any run of words at ``similarity`` or more.

    Let n be the item's shingles, s those shared, u those of either side that
    are not: s / (s + u) >= similarity.  The shared shingles of the run lie in
    stretches that are consecutive in the item too.  Two neighbouring ones
    are parted by 4 - r unshared shingles of the run at least, if no more than
    r words in a row (up to 4) stand twice in the item.  That bounds the
    number of stretches, and the longest has its share of s at least.
    """
    n = len(h) - WORDS + 1
    if n < 2:
        return len(h)
    raw, repeat = h.tobytes(), 0
    while repeat < WORDS - 1 and len({raw[8 * i:8 * (i + repeat + 1)] for i in range(len(h) - repeat)}) < len(h) - repeat:
        repeat += 1
    exact = Fraction(str(similarity))
    a, b = exact.numerator, exact.denominator
    shared = np.arange(max(1, -(-n * a // b)), n + 1)
    free = shared * (b - a) // a - (n - shared)           # unshared shingles left for the run
    shared, free = shared[free >= 0], free[free >= 0]
    parts = free // (WORDS - 1 - repeat) + 1 if repeat < WORDS - 1 else shared
    return int((-(-shared // parts)).min()) + WORDS - 1


def _shingle_hashes(h: np.ndarray, words: int = WORDS) -> np.ndarray:
    """64-bit hashes of the shingles that begin at every word."""
    n = max(0, len(h) - words + 1)
    out = np.zeros(n, np.uint64)
    for k in range(words):
        out = (out + h[k:k + n]) * _STEP
    return mix64(out)


class BestRun:
    """Search for the run of words most similar to one item."""

    def __init__(self, h: np.ndarray, similarity: float):
        self.words = h
        self.least = Fraction(str(similarity))
        self.keys, self.many = np.unique(_shingle_hashes(h), return_counts=True)
        self.total = int(self.many.sum())

    def __call__(self, h: np.ndarray) -> tuple[int, int] | None:
        """First word and words of the best run in ``h`` (the first of equals,
        the shortest from there), or None."""
        if len(self.words) < WORDS:                       # one shingle, the item's own length
            n = len(self.words)
            ends = len(h) - n + 1
            same = np.ones(max(0, ends), bool)
            for k in range(n):
                same &= h[k:k + len(same)] == self.words[k]
            at = np.flatnonzero(same)
            return (int(at[0]), n) if len(at) else None
        hashes = _shingle_hashes(h)
        key = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        at = np.flatnonzero(self.keys[key] == hashes)     # a best run begins and ends with a shared shingle
        if not len(at):
            return None
        key = key[at]
        # an occurrence counts in a run that does not reach back to the occurrence
        # that has used up the item's count
        order = np.argsort(key, kind="stable")
        group = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
        rank = np.arange(len(at)) - np.repeat(group, np.diff(np.r_[group, len(at)]))
        used = np.full(len(at), -1)
        limit = self.many[key[order]]
        late = np.flatnonzero(rank >= limit)
        used[order[late]] = at[order[late - limit[late]]]
        # s / (s + u) > a / b is (a + b) s - a (run + item) > 0; with every occurrence
        # counted this bounds all runs from a start at once
        a, b = self.least.numerator, self.least.denominator
        count = np.arange(1, len(at) + 1)
        open_, best = np.ones(len(at), bool), None

        def bounds():
            value = (a + b) * count - a * at
            top = np.maximum.accumulate(value[::-1])[::-1]
            return top - (a + b) * (count - 1) + a * (at - 1)
        bound = bounds()
        while True:
            left = np.flatnonzero(open_ & (bound >= a * self.total))
            if best is not None:
                left = left[(bound[left] > a * self.total) | (left < best[0])]
            if not len(left):
                break
            i = int(left[np.argmax(bound[left])])
            open_[i] = False
            last = int(np.searchsorted(at, at[i] + self.total * b // a + 1))
            shared = np.cumsum(used[i:last] < at[i])
            both = at[i:last] - at[i] + 1 + self.total - shared
            j = int(np.argmax(shared / both))
            s, t = int(shared[j]), int(both[j])
            if s * b > a * t or s * b == a * t and (best is None or i < best[0]):
                best = (i, i + j)
                if s * b > a * t:
                    a, b = s, t
                    bound = bounds()
        if best is None:
            return None
        first, last = int(at[best[0]]), int(at[best[1]])
        return first, last - first + WORDS


class ItemIndex:
    """Fingerprints of a block of items and their multi-index.  Windows are
    sized so that no place at ``similarity`` is missed; without one, an item
    gets the largest size that it holds."""

    def __init__(self, items: list[tuple[int, bytes]], radius: int = RADIUS, similarity: float | None = None):
        self.radius = radius
        self.items = [(i, np.frombuffer(h, np.uint64)) for i, h in items]
        self.counts = [shingle_counts(h) for _, h in self.items]
        if similarity is not None:
            self.lengths = np.array([len(h) for _, h in self.items])
            self.runs = [BestRun(h, similarity) for _, h in self.items]
            known = np.unique(np.concatenate([r.keys for r in self.runs]))
            self.known = np.zeros(1 << 22, bool)
            self.known[known >> np.uint64(42)] = True
        edges = [round(64 * k / (radius + 1)) for k in range(radius + 2)]
        self.cuts = [(np.uint64(a), b - a) for a, b in zip(edges, edges[1:])]
        by_size: dict[int, list] = {}
        for k, (_, h) in enumerate(self.items):
            common = len(h) if similarity is None else common_words(h, similarity)
            size = max(s for s in LADDER if s <= common)
            prints = window_prints(_signs(h), size)
            step = 1 if similarity is None else common - size + 1
            offset = np.arange(0, len(prints), step)
            by_size.setdefault(size, []).append((prints[offset], np.full(len(offset), k), offset))
        self.sizes = {}
        for size, parts in by_size.items():
            prints, item, offset = (np.concatenate(x) for x in zip(*parts))
            tables = []
            for shift, width in self.cuts:
                key = (prints >> shift) & np.uint64((1 << width) - 1)
                order = np.argsort(key, kind="stable")
                seen = np.zeros(1 << width, bool)
                seen[key] = True
                tables.append((seen, key[order], order))
            self.sizes[size] = (prints, item, offset, tables)

    def candidates(self, size: int, windows: np.ndarray):
        """(window, entry) pairs within the radius."""
        prints, _, _, tables = self.sizes[size]
        found = []
        for (shift, width), (seen, keys, order) in zip(self.cuts, tables):
            key = (windows >> shift) & np.uint64((1 << width) - 1)
            at = np.flatnonzero(seen[key])
            low, high = np.searchsorted(keys, key[at]), np.searchsorted(keys, key[at], side="right")
            many = high - low
            total = int(many.sum())
            if not total:
                continue
            rows = np.repeat(at, many)
            ends = np.cumsum(many)
            entry = order[np.arange(total) - np.repeat(ends - many, many) + np.repeat(low, many)]
            near = np.bitwise_count(windows[rows] ^ prints[entry]) <= self.radius
            found.append(np.stack([rows[near], entry[near]], axis=1))
        if not found:
            return np.zeros((0, 2), np.int64)
        return np.unique(np.concatenate(found), axis=0)


@lru_cache(maxsize=4)
def _index(items: tuple, radius: int, similarity: float) -> ItemIndex:
    return ItemIndex(list(items), radius, similarity)


def find_items(index: ItemIndex, raw: np.ndarray, offsets: np.ndarray, similarity: float) -> dict[tuple, tuple]:
    """{(row, item): (similarity, first word, words)} of the items found."""
    h, at, _ = words_of(raw, offsets)
    best: dict[tuple, tuple] = {}
    votes = _signs(h)
    # running count of the words that begin a shingle of any item
    known = np.zeros(len(h) + 1, np.int64)
    hashes = _shingle_hashes(h)
    known[1:len(hashes) + 1] = index.known[hashes >> np.uint64(42)]
    known = np.cumsum(known)
    places = []
    for size in index.sizes:
        pairs = index.candidates(size, window_prints(votes, size))
        row = np.searchsorted(at, pairs[:, 0], side="right") - 1
        inside = pairs[:, 0] + size <= at[row + 1]
        row, pairs = row[inside], pairs[inside]
        item = index.sizes[size][1][pairs[:, 1]]
        # no run at the similarity has more words than this
        reach = (index.lengths[item] / similarity).astype(np.int64) + WORDS
        low, high = np.maximum(at[row], pairs[:, 0] + size - reach), np.minimum(at[row + 1], pairs[:, 0] + reach)
        shingles = np.maximum(0, index.lengths[item] - WORDS + 1)
        can = (known[high] - known[low] >= np.floor(similarity * shingles)) | (shingles == 0)
        places.append(np.stack([row, item, low, high], axis=1)[can])
    places = np.concatenate(places)
    places = places[np.lexsort(places.T[::-1])]
    at_pair = np.flatnonzero(np.r_[True, (places[1:, :2] != places[:-1, :2]).any(axis=1)]) if len(places) else []
    for part in np.split(places, at_pair[1:]) if len(places) else []:
        r, k = part[0, :2].tolist()
        # places that overlap are searched together
        ends = np.maximum.accumulate(part[:, 3])
        cuts = np.flatnonzero(np.r_[True, part[1:, 2] >= ends[:-1]])
        for low, high in zip(part[cuts, 2].tolist(), ends[np.r_[cuts[1:] - 1, len(part) - 1]].tolist()):
            run = index.runs[k](h[low:high])
            if run is None:
                continue
            begin, end = low + run[0], low + sum(run)
            like = weighted_similarity(index.counts[k], shingle_counts(h[begin:end]))
            if like >= similarity and like > best.get((r, k), (0.0,))[0]:
                best[(r, k)] = (like, int(begin - at[r]), int(end - begin))
    return best


def _match(items: tuple, radius: int, similarity: float):
    def run(batches):
        index = _index(items, radius, similarity)
        for batch in batches:
            for part in byte_slices(batch, "text", 1 << 20):
                ids = part.column("doc_id").to_pylist()
                best = find_items(index, *utf8_buffer(part, "text"), similarity)
                rows = [(ids[r], index.items[k][0], *hit) for (r, k), hit in sorted(best.items())]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds)],
                    ["doc_id", "item_id", "similarity", "first_word", "n_words"])
    return run


def _drop(items: tuple, radius: int, similarity: float, text: str):
    def run(batches):
        index = _index(items, radius, similarity)
        for batch in batches:
            for part in byte_slices(batch, text, 1 << 20):
                clean = np.ones(part.num_rows, bool)
                clean[[r for r, _ in find_items(index, *utf8_buffer(part, text), similarity)]] = False
                yield part.filter(pa.array(clean))
    return run


def _item_words(batches):
    for batch in batches:
        h, at, _ = words_of(*utf8_buffer(batch, "text"))
        yield pa.RecordBatch.from_arrays([
            batch.column("item_id"),
            pa.array([h[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())], ["item_id", "words"])


def item_blocks(benchmark: DataFrame, block_items: int):
    """The benchmark's items with words, ``block_items`` at a time: the stated
    items are read block by block, never all at once."""
    items = pick(benchmark, item_id="item_id", text="text").withColumn("item_id", F.col("item_id").cast("long")) \
        .mapInArrow(_item_words, "item_id long, words binary").where(F.length("words") > 0)
    block: list[tuple[int, bytes]] = []
    for row in items.toLocalIterator():
        block.append((row["item_id"], bytes(row["words"])))
        if len(block) == block_items:
            yield tuple(block)
            block = []
    if block:
        yield tuple(block)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, radius: int = RADIUS,
                 block_items: int = 20_000, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: every benchmark item
    found in a row, at its most similar place."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    shape = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    found = [rows.mapInArrow(_match(block, radius, similarity), shape) for block in item_blocks(benchmark, block_items)]
    if not found:
        return docs.sparkSession.createDataFrame([], shape)
    return reduce(DataFrame.unionByName, found)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, radius: int = RADIUS,
                      block_items: int = 20_000, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    prepare(docs.sparkSession)
    for block in item_blocks(benchmark, block_items):
        docs = docs.mapInArrow(_drop(block, radius, similarity, text), docs.schema)
    return docs
