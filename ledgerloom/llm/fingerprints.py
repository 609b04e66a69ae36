"""Document fingerprints by one-permutation MinHash, in DataFrame functions.

Every shingle of ``WORDS`` lower-cased words is hashed once; the top bits of
the hash choose one of ``BINS`` bins and each bin keeps its smallest hash.  An
empty bin borrows from the filled bin that comes first in the empty bin's own
pseudo-random order of bins (optimal densification: the order depends on the
bins alone, so two documents borrow alike).  The low ``BITS`` bits of every
bin are stored, packed and printed as hex.  The likeness of two fingerprints
is the share of equal bins, corrected for the ``2**-BITS`` chance that
different hashes agree in the stored bits.

One sort does the binning: the hashes and one "empty" mark per bin (the bin's
largest value) are sorted, and the first value of each bin is kept.

Defined results: null text is read as empty; a text without words has the
fingerprint ``""``, like another such text (1.0) and unlike any other (0.0); a
text of fewer words than a shingle is one shingle; equal texts have equal
fingerprints; a null ``doc_id`` comes last; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blank, pick, prepare

WORDS, BINS, BIN_BITS, BITS = 5, 128, 7, 8
#: Most blocks the table is cut into to find each row's neighbour; the list
#: of blocks (24 bytes each) is what is broadcast.
MOST_BLOCKS = 65_536
_REST = (1 << (64 - BIN_BITS)) - 1


def let(value: Column, body) -> Column:
    """``body`` applied to ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - BIN_BITS)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """One 64-bit hash per word shingle; none for a text without words."""
    tokens = F.filter(F.split(F.lower(text), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    hashes = F.transform(tokens, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        last = F.size(h) - words
        many = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)]))
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(last < 0, F.array(F.xxhash64(h))) \
            .otherwise(many)
    return let(hashes, shingles)


def bin_codes(text: Column) -> Column:
    """The stored low-order bits of every bin, or an empty array."""
    marks = F.array(*[F.lit(_signed((b << (64 - BIN_BITS)) | _REST)) for b in range(BINS)])
    is_mark = lambda x: x.bitwiseAND(F.lit(_REST)) == F.lit(_REST)

    def densify(bins: Column) -> Column:
        def fill(filled: Column) -> Column:
            def donor(x: Column) -> Column:
                turn = F.array_min(F.transform(filled, lambda y: F.xxhash64(_bin(x), _bin(y)).bitwiseAND(
                    F.lit(_signed(((1 << 64) - 1) ^ (BINS - 1)))).bitwiseOR(_bin(y))))
                # bins are kept in signed order: the upper half comes first
                place = (turn.bitwiseAND(F.lit(BINS - 1)) + F.lit(BINS // 2)) % F.lit(BINS)
                return F.get(bins, place.cast("int"))
            return F.transform(bins, lambda x: F.when(is_mark(x), donor(x)).otherwise(x))
        return let(F.filter(bins, lambda x: ~is_mark(x)), fill)

    def from_hashes(hashes: Column) -> Column:
        first = let(F.sort_array(F.concat(hashes, marks)), lambda s: F.filter(
            s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1)))))
        codes = F.transform(let(first, densify), lambda x: F.pmod(x, F.lit(1 << BITS)).cast("smallint"))
        return F.when(F.size(hashes) == 0, F.array().cast("array<smallint>")).otherwise(codes)
    return let(shingle_hashes(text), from_hashes)


def packed(codes: Column) -> Column:
    """Codes as one hex string of ``BITS`` bits a bin."""
    return F.array_join(F.transform(codes, lambda x: F.lpad(F.lower(F.hex(x.cast("int"))), BITS // 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Bias-corrected share of equal bins, 0 to 1."""
    chance = 2.0 ** -BITS
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")) \
        .otherwise(F.greatest(F.lit(0.0), (same - chance) / (1 - chance)))


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, fingerprint of every row."""
    return pick(docs, doc_id=doc_id, text=text).select(
        "doc_id", "text", packed(bin_codes(blank("text"))).alias("fingerprint"))


def with_next(rows: DataFrame, carried: list[str]) -> DataFrame:
    """Each row with its follower's ``carried`` columns as ``next_<name>``, in
    descending doc_id (equal ids by text; after the last comes the first).

    The id range is cut into blocks; a block's first row is also sent, as a
    guest, to the block before it, so one exchange of the rows is enough."""
    low, high, n = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    n_blocks = max(1, min(MOST_BLOCKS, n // 1024))
    width = ((high or 0) - (low or 0)) // n_blocks + 1
    block = F.coalesce(F.least(F.lit(n_blocks - 1), F.floor(
        (F.lit(float(high or 0)) - F.col("doc_id").cast("double")) / F.lit(float(width)))), F.lit(n_blocks - 1))
    rows = rows.withColumn("block", block.cast("long"))
    heads = rows.groupBy("block").agg(F.max("doc_id").alias("head"))
    order = Window.orderBy("block")
    heads = heads.select("block", "head", F.coalesce(
        F.lag("block").over(order), F.max("block").over(order.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("before"))
    at = heads.select(F.col("block").alias("head_block"), "head", "before")
    dealt = rows.join(F.broadcast(at), (F.col("block") == F.col("head_block")) & F.col("doc_id").eqNullSafe(
        F.col("head")), "left")
    own = F.struct(F.col("block").alias("block"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("before").alias("block"), F.lit(True).alias("guest"))
    dealt = dealt.withColumn("seat", F.explode(
        F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, visit)))) \
        .select("doc_id", *carried, F.col("seat.block").alias("block"), F.col("seat.guest").alias("guest"))
    w = Window.partitionBy("block").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    return dealt.select("doc_id", *carried, "guest", *[F.lead(c).over(w).alias(f"next_{c}") for c in carried]) \
        .where(~F.col("guest")).drop("guest")


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's fingerprint, that of its edited text (the last third of the
    code points replaced by the first as many of the next document, descending
    doc_id), and the likeness of the fingerprint to the edited text's and to
    the next document's."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id=doc_id, text=text).select("doc_id", blank("text").alias("text"))
    near = with_next(rows.withColumn("codes", bin_codes(F.col("text"))), ["text", "codes"])
    third = F.floor(F.char_length("text") / 3).cast("int")
    near = near.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited", F.concat(
        F.substring("text", F.lit(1), F.char_length("text") - third), F.substring("next_text", F.lit(1), third)))
    near = near.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "codes", "next_codes",
                       bin_codes(F.col("edited")).alias("edited_codes"))
    return near.select("doc_id", "n_chars", "edited_sha256", packed(F.col("codes")).alias("fingerprint"),
                       packed(F.col("edited_codes")).alias("edited_fingerprint"),
                       likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
                       likeness(F.col("codes"), F.col("next_codes")).alias("near_next"))
