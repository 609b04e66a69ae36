"""Near-duplicate groups by SuperMinHash, banding, verification, union-find.

A document's set holds its distinct word shingles.  Each element of a set owns
a pseudo-random permutation of the ``SLOTS`` signature slots; at level j it
offers the rank j + r (0 <= r < 1) to the j-th slot of its permutation, and a
slot keeps the smallest rank.  Levels are processed for all elements of a
batch together and stop for a document as soon as all its slots are taken,
because every later rank is larger.

1. Documents with equal sets form one class (a 64-bit digest of the set).
2. Class signatures are cut into ``BANDS`` bands; equal bands make buckets.  At
   a similarity of 0.8 a pair misses all 32 bands of 4 with probability 5e-8.
3. Every member of a bucket is verified on full sets against the bucket's
   head, the set that meets most others (a text that the others are edits of
   stands out so); union-find groups the links.
4. Links between members that step 3 left in different groups are found by a
   prefix-filter join over the members of buckets that span several groups.
   Their shingles are ordered by rarity.  Sets of sizes m <= n with similarity
   t or more share ceil(t / (1 + t) * (m + n)) shingles, so they share one among
   the first n - that + 1 of each; the larger set looks them up per narrow
   class of partner sizes, which keeps those prefixes short.  Pairs of one
   group, of unfit sizes, or whose places leave too few shingles to share, are
   dropped inside the join; what is left is verified on full sets.

A large group of near copies is one group after step 3, and copies changed too
much to be linked have their own rare changes in front, so no bucket is ever
expanded into pairs; the join is exact, so no link between members of buckets
is lost.  Each link is confirmed: 100 * |A & B| >= 80 * |A | B| by default.

Defined results: null and empty texts and texts without words have an empty
set, belong to no group and are kept; a null ``doc_id`` never names a group
with other members; repeated rows are one class; ``component_id`` is the
smallest id of the group; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_slices, mix64, pick, prepare, stage, utf8_buffer
from .components import components
from .shingles import shingle_sets

SLOTS, BANDS = 128, 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ALL = (1 << 64) - 1
#: Elements whose permutations are held at a time.
_CHUNK = 150_000


def signatures(flat: np.ndarray, at: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signature (rows x slots) of each set of element hashes;
    an empty set's slots are infinite."""
    rows = len(at) - 1
    out = np.full((rows, slots), np.inf)
    start = 0
    while start < rows:                      # runs of rows of bounded size
        stop = int(np.searchsorted(at, at[start] + _CHUNK, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        _levels(flat[at[start]:at[stop]], np.diff(at[start:stop + 1]), out[start:stop])
        start = stop
    return out


def _draw(x: np.ndarray, level: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    y = mix64(x + np.uint64((level + 1) * int(_STEP) & _ALL))
    rank = level + (y >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
    pick_ = mix64(y) >> np.uint64(32)
    return rank, level + ((pick_ * np.uint64(slots - level)) >> np.uint64(32)).astype(np.int64)


def _levels(x: np.ndarray, sizes: np.ndarray, out: np.ndarray) -> None:
    slots = out.shape[1]
    row = np.repeat(np.arange(len(sizes)), sizes)
    flat = out.reshape(-1)
    perm = None
    for level in range(slots):
        rank, k = _draw(x, level, slots)
        if perm is None:
            slot = k
        else:
            each = np.arange(len(x))
            slot = perm[each, k]
            perm[each, k] = perm[:, level]
        np.minimum.at(flat, row * slots + slot, rank)
        open_rows = np.isinf(out).any(axis=1)
        stay = open_rows[row]
        if not stay.any():
            return
        if perm is None:
            x, row, k = x[stay], row[stay], k[stay]
            perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(x), 1))
            perm[np.arange(len(x)), k] = 0
        elif not stay.all():
            x, row, perm = x[stay], row[stay], perm[stay]


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per row and band (rows x bands)."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, -1)
    weights = mix64(np.arange(1, bits.shape[2] + 1, dtype=np.uint64) * _STEP) | np.uint64(1)
    seed = mix64(np.arange(1, bands + 1, dtype=np.uint64))
    return mix64((mix64(bits) * weights).sum(axis=2, dtype=np.uint64) + seed)


def set_digests(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(flat[a:b].tobytes(), digest_size=8).digest(), "little", signed=True)
                     for a, b in zip(at[:-1], at[1:])], np.int64)


def _sign(words: int):
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text", 1 << 20):
                flat, at = shingle_sets(*utf8_buffer(part, "text"), words)
                keys = band_keys(signatures(flat, at)).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(set_digests(flat, at)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS),
                                             pa.array(keys.reshape(-1))), part.column("text_key")],
                    ["doc_id", "n_shingles", "cls", "bands", "text_key"])
    return run


def _check_class(words: int):
    """Keep the texts whose set is the class's (ids may repeat)."""
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text", 1 << 20):
                same = set_digests(*shingle_sets(*utf8_buffer(part, "text"), words)) == np.asarray(part.column("cls"))
                yield part.select(["cls", "text"]).filter(pa.array(same))
    return run


def _verify(words: int, percent: int):
    """Whether the pairs (a, head) are linked, on their full sets."""
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text_a", 1 << 20):
                fa, ia = shingle_sets(*utf8_buffer(part, "text_a"), words)
                heads = part.column("head").to_pylist()
                first: dict[int, int] = {}
                for i, key in enumerate(heads):
                    first.setdefault(key, i)
                places = {key: k for k, key in enumerate(first)}
                unique = part.take(pa.array(list(first.values()), pa.int64()))
                fb, ib = shingle_sets(*utf8_buffer(unique, "text_head"), words)
                linked = []
                for i, key in enumerate(heads):
                    x = fa[ia[i]:ia[i + 1]]
                    k = places[key]
                    y = fb[ib[k]:ib[k + 1]]
                    where = np.searchsorted(y, x)
                    where[where == len(y)] = 0
                    n = int((y[where] == x).sum())
                    linked.append(100 * n >= percent * (len(x) + len(y) - n))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("head"), pa.array(linked, pa.bool_())],
                                                 ["a", "head", "linked"])
    return run


def _shingles_of(words: int):
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text", 1 << 20):
                flat, at = shingle_sets(*utf8_buffer(part, "text"), words)
                owner = np.repeat(np.asarray(part.column("cls")), np.diff(at))
                for k in range(0, len(flat), 100_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(owner[k:k + 100_000]), pa.array(flat[k:k + 100_000].view(np.int64))], ["cls", "s"])
    return run


#: Ratio of the size classes of the prefix join.
SIZE_STEP = 1.02


def _open_pairs(sets: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Candidate links (a, head) between the sets of different roots; ``sets``:
    cls, size, root."""
    share = percent / (100 + percent)          # of m + n that linked sets have in common
    step = float(np.log(SIZE_STEP))
    size_class = lambda n: F.floor(F.log(n) / step).cast("int")
    needed = lambda m_plus_n: F.ceil(m_plus_n * share - 1e-6)
    shingles = stage(texts.join(sets.select("cls"), "cls", "left_semi").mapInArrow(
        _shingles_of(words), "cls long, s long"), "open-shingles")
    common = shingles.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # shingles of one set alone come first and meet nothing: only their number matters
    ordered = shingles.join(common, "s").groupBy("cls").agg(
        F.sort_array(F.collect_list(F.struct("df", "s"))).alias("order")).join(sets, "cls")
    lone = F.col("size") - F.size("order")
    first = F.col("size") - needed(F.col("size") * 2) + 1
    last = F.col("size") - needed(F.col("size") + F.ceil(F.col("size") * (percent / 100))) + 1
    # only the longest prefix is ever looked up
    cut = F.slice("order", F.lit(1), F.greatest(last - lone, F.lit(0)).cast("int"))
    placed = stage(ordered.select("cls", "size", "root", lone.alias("lone"), first.alias("first"),
                                  F.posexplode(F.transform(cut, lambda x: x["s"])).alias("p", "s"))
                   .withColumn("place", F.col("p") + F.col("lone") + 1), "open-prefixes")
    index = placed.where("place <= first").withColumn("part", size_class(F.col("size")))
    smallest = F.greatest(F.ceil(F.pow(F.lit(SIZE_STEP), F.col("part")) - 1e-6), F.ceil(F.col("size") * (percent / 100)))
    probe = placed.withColumn("part", F.explode(F.sequence(
        size_class(F.ceil(F.col("size") * (percent / 100))), size_class(F.col("size"))))) \
        .where(F.col("place") <= F.col("size") - needed(F.col("size") + smallest) + 1)
    f, v = index.alias("f"), probe.alias("v")
    fits = (F.struct("f.size", "f.cls") < F.struct("v.size", "v.cls")) & (F.col("f.root") != F.col("v.root")) \
        & (F.col("f.size") * 100 >= F.col("v.size") * percent) \
        & (1 + F.least(F.col("f.size") - F.col("f.place"), F.col("v.size") - F.col("v.place"))
           >= needed(F.col("f.size") + F.col("v.size")))
    return f.join(v, (F.col("f.s") == F.col("v.s")) & (F.col("f.part") == F.col("v.part")) & fits).select(
        F.col("v.cls").alias("a"), F.col("f.cls").alias("head")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row, and the group's
    number (null without words) and a text key: rows are linked when
    100 * |A & B| >= percent * |A | B| on their shingle sets."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = stage(rows.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        _sign(words), "doc_id long, n_shingles long, cls long, bands array<long>, text_key long"), "signed")
    classes = stage(signed.where("n_shingles > 0").groupBy("cls").agg(
        F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("n_shingles").alias("size")),
        "classes")

    # buckets of two members or more; a set's degree says how many it meets
    entries = classes.select(F.explode("bands").alias("bucket"), "cls", "size")
    several = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage(entries.join(several, "bucket"), "buckets")
    degree = members.groupBy("cls").agg(F.sum("n").alias("degree"))
    texts = _texts(rows, classes, members, words)

    def verified(pairs: DataFrame) -> DataFrame:
        return pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a") \
            .join(texts.select(F.col("cls").alias("head"), F.col("text").alias("text_head")), "head") \
            .mapInArrow(_verify(words, percent), "a long, head long, linked boolean") \
            .where("linked").select("a", F.col("head").alias("b"))

    heads = members.join(degree, "cls").groupBy("bucket").agg(F.max(F.struct("degree", "cls")).alias("h")) \
        .select("bucket", F.col("h.cls").alias("head"))
    links = stage(verified(members.join(heads, "bucket").where("cls != head").select(
        F.col("cls").alias("a"), "head").distinct()), "star")
    groups = stage(components(links), "groups")

    # buckets that span several groups: their members' links to other groups
    rooted = members.join(groups.select(F.col("vertex").alias("cls"), "root"), "cls", "left") \
        .withColumn("root", F.coalesce("root", "cls"))
    spans = rooted.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1")
    sets = stage(rooted.join(spans.select("bucket"), "bucket", "left_semi").select("cls", "size", "root").distinct(), "open")
    late = stage(verified(_open_pairs(sets, texts, words, percent)), "late")
    if not late.isEmpty():
        groups = stage(components(late.unionByName(groups.select(F.col("vertex").alias("a"), F.col("root").alias("b")))),
                       "groups")

    named = classes.select("cls", "first_id").join(
        groups.select(F.col("vertex").alias("cls"), "root"), "cls", "left") \
        .select("cls", "first_id", F.coalesce("root", "cls").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "root").select("cls", "component_id", "root")
    return signed.select("doc_id", "n_shingles", "text_key", F.when(F.col("n_shingles") > 0, F.col("cls")).alias("cls")) \
        .join(named, "cls", "left").select(
            "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(
                F.col("component_id")).alias("component_id"), "root", "text_key") \
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
                "root", "text_key")


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of every near-duplicate group (the
    smallest id; of rows that share it, the smallest text key) and every row
    without words."""
    groups = stage(near_duplicates(docs, words, percent, doc_id, text), "near-groups")
    turn = F.row_number().over(Window.partitionBy("root").orderBy("text_key"))
    kept = groups.where("kept")
    worded = F.col("root").isNotNull().alias("_keep_worded")
    keep = kept.where("root is not null").withColumn("turn", turn).where("turn = 1").select("doc_id", "text_key", worded) \
        .unionByName(kept.where("root is null").select("doc_id", "text_key", worded))
    keep = stage(keep.distinct().select(F.col("doc_id").alias("_keep_id"), F.col("text_key").alias("_keep_key"),
                                        "_keep_worded"), "keep")

    def kept_of(some: DataFrame) -> DataFrame:
        # columns named by their table: docs may have columns of the same names
        return docs.join(some, docs[f"`{doc_id}`"].cast("long").eqNullSafe(some["_keep_id"])
                         & F.xxhash64(docs[f"`{text}`"]).eqNullSafe(some["_keep_key"]), "left_semi")
    repeated = groups.where("root is not null").groupBy("doc_id", "text_key").count().where("count > 1")
    if repeated.isEmpty():
        return kept_of(keep)
    # only rows of a group are repeats of each other
    return kept_of(keep.where("_keep_worded")).dropDuplicates([doc_id, text]).unionByName(
        kept_of(keep.where("not _keep_worded")))


def _texts(rows: DataFrame, classes: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """One text per class that is in a bucket."""
    wanted = classes.select("cls", "first_id").join(members.select("cls").distinct(), "cls", "left_semi")
    found = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["first_id"])).select("cls", "text") \
        .mapInArrow(_check_class(words), "cls long, text string")
    return stage(found.groupBy("cls").agg(F.min("text").alias("text")), "class-texts")
