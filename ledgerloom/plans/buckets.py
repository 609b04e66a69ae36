"""Keyed tables in hash buckets, so that a run opens and rewrites only the
buckets its keys fall into.

``KeySet`` is an insert-only table (hubs, links).  Every run's rows lie in
``<name>/run=<id>/_bucket=<n>/``; ``<name>/sketch/run=<id>/`` holds, for every
bucket, two bitmaps of hashed keys (a Bloom filter of two parts) of all rows
up to that run.  A run probes the bitmaps with its candidates: a candidate
that misses either bitmap is new for certain; only the buckets of the others
are opened for the exact anti-join.  Too small a bitmap costs opened buckets,
never a wrong row.

``BucketState`` holds one current row a key (a satellite's latest version, the
snapshot's open versions).  A run writes the buckets it changed, whole, to
``<name>/data/run=<id>/_bucket=<n>/``; ``<name>/manifest/run=<id>/`` names for
every bucket the run whose folder is live (a row a bucket).  The files of an
unchanged bucket stay the files they were.

Both compare against published runs before their own, so a retried run
reproduces its rows and overwrites only its own folders.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import packed, unpacked
from .tables import stage, write

#: Bits of one bitmap block (fixed by the bitmap functions).
BLOCK = 32_768
#: Bits of each of the two bitmaps of a bucket, a multiple of ``BLOCK``.  At 16
#: bits a key one new key in some 250 looks stored.
BITS = BLOCK


def bucket_of(key: str, buckets: int) -> Column:
    return _place(buckets, F.lit("bucket"), F.col(key)).cast("int")


def _place(places: int, *parts: Column) -> Column:
    """Never NULL, and said so: a join on it adds no NULL checks, which would
    hash every key once more for each check before the rows are distinct."""
    return F.coalesce(F.pmod(F.xxhash64(*parts), F.lit(places)), F.lit(0).cast("bigint"))


def _buckets(df: DataFrame) -> list[int]:
    """The distinct buckets of a table (at most as many as there are buckets)."""
    return sorted(r["_bucket"] for r in df.select("_bucket").distinct().collect())


def _write(df: DataFrame, path: str) -> None:
    """A bucket gets a file from every task that holds rows of it: no exchange
    is made that would put a whole bucket into one task."""
    write(df, path, "_bucket")


def version(key: str, hashdiff: str = "hashdiff") -> Column:
    """A key and its hashdiff as one digest of 16 bytes."""
    k = packed(key)
    return F.unhex(F.md5(F.concat(F.octet_length(k).cast("string").cast("binary"), F.lit(b":"), k, packed(hashdiff))))


#: Most keys of a few (new ones, false marks) that go to every task.
FEW = 4_000_000
#: A bitmap of digests has this many bits a digest (of which a digest sets
#: ``PROBES`` in its block), at most 20,000 blocks (82 MB) in all.
BITS_A_DIGEST, PROBES, MOST_BLOCKS = 12, 4, 20_000


class Marks:
    """A Bloom filter of the digests ``_k0`` of a written table, in blocks of
    ``BLOCK`` bits that go to every task.  A digest that is not marked is not
    among them for certain; too few bits mark more of the others."""

    def __init__(self, digests: DataFrame):
        self.blocks = max(1, min(MOST_BLOCKS, digests.count() * BITS_A_DIGEST // BLOCK + 1))
        places = digests.select(self._block(), F.explode(F.array(*self._places())).alias("_place"))
        word = lambda i: F.conv(F.hex(F.substring("bits", i * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
        self.words = stage(places.groupBy("_block").agg(F.bitmap_construct_agg("_place").alias("bits")).select(
            F.col("_block").alias("_k0"), F.transform(F.sequence(F.lit(0), F.lit(BLOCK // 64 - 1)), word).alias("_k1")),
            "marks").toDF("_block", "_words")

    def _block(self) -> Column:
        return _place(self.blocks, F.lit("block"), F.col("_k0")).alias("_block")

    @staticmethod
    def _places() -> list[Column]:
        spread = F.xxhash64(F.lit("places"), F.col("_k0"))
        return [F.shiftrightunsigned(spread, 15 * i).bitwiseAND(F.lit(BLOCK - 1).cast("bigint")) for i in range(PROBES)]

    def marked(self, rows: DataFrame, yes: bool = True) -> DataFrame:
        """The rows whose ``_k0`` is (is not) marked."""
        # a word holds its eight bytes from the highest down, a byte its bits from the lowest up
        bits = [F.getbit(F.get("_words", F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56)).cast("int")) == 1
                for p in self._places()]
        every = F.coalesce(reduce(lambda a, b: a & b, bits), F.lit(False))
        return rows.withColumn("_block", self._block()).join(F.broadcast(self.words), "_block", "left") \
            .where(every if yes else ~every).drop("_block", "_words")


def _having(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """``rows`` whose digest ``name`` is among the packed ``keys``, a written
    table: sent to the rows if they are few, else only marked rows are exchanged."""
    rows = rows.withColumn("_k0", packed(name))
    if keys.count() <= FEW:
        return rows.join(F.broadcast(keys), "_k0", "left_semi").drop("_k0")
    return Marks(keys).marked(rows).join(keys, "_k0", "left_semi").drop("_k0")


def _changed(rows: DataFrame, key: str, latest: DataFrame) -> DataFrame:
    """``rows`` whose version is not among the ``latest`` ones.  Digests of
    versions are exchanged and the changed ones marked; the rows that are
    marked have changed but for the latest versions that are marked too."""
    digests = lambda df: df.select(version(key).alias("_k0"))
    changed = stage(digests(rows).distinct().join(digests(latest), "_k0", "left_anti"), "changed-versions")
    marks = Marks(changed)
    wrong = stage(marks.marked(digests(latest)), "false-marks")
    few = F.broadcast(wrong) if wrong.count() <= FEW else wrong
    return marks.marked(rows.withColumn("_k0", version(key))).join(few, "_k0", "left_anti").drop("_k0")


@dataclass
class KeySet:
    """An insert-only table with one row a ``key``."""

    store: object                  # plans.build.TableStore
    name: str
    key: str
    bits: int = BITS

    def _place(self, part: int) -> Column:
        return _place(self.bits, F.lit(part), F.col(self.key))

    def _sketch_of(self, rows: DataFrame) -> DataFrame:
        places = rows.select("_bucket", F.explode(F.array(*[F.struct(
            F.lit(p).alias("part"), self._place(p).alias("place")) for p in (0, 1)])).alias("p")).select("_bucket", "p.*")
        return places.groupBy("_bucket", "part", F.floor(F.col("place") / BLOCK).cast("int").alias("block")).agg(
            F.bitmap_construct_agg(F.col("place") % BLOCK).alias("bits"))

    def _maybe_stored(self, rows: DataFrame, sketch: DataFrame) -> DataFrame:
        for p in (0, 1):
            place = self._place(p)
            blocks = sketch.where(F.col("part") == p).select(F.col("_bucket"), F.col("block").alias("_block"), "bits")
            byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("_place") % BLOCK / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            rows = rows.withColumn("_place", place).withColumn("_block", F.coalesce(F.floor(F.col("_place") / BLOCK).cast("int"), F.lit(0))) \
                .join(blocks, ["_bucket", "_block"]) \
                .where(F.getbit(byte.cast("long"), (F.col("_place") % 8).cast("int")) == 1).drop("_place", "_block", "bits")
        return rows

    def opened(self, candidates: DataFrame, before: str) -> list[int]:
        """The buckets that may hold a candidate (``candidates`` has ``_bucket``)."""
        sketch = self.store.latest(f"{self.name}/sketch", before)
        return [] if sketch is None else _buckets(self._maybe_stored(candidates, sketch))

    def stored(self, before: str, buckets: list[int] | None = None) -> DataFrame | None:
        """Rows of the published runs before ``before``, of some buckets."""
        rows = self.store.every_run(self.name, before, keep_bucket=True)
        if rows is None or buckets is None:
            return rows
        return rows.where(F.col("_bucket").isin(buckets)) if buckets else None

    def new_rows(self, candidates: DataFrame, run_id: str) -> DataFrame:
        """The candidates whose key is not stored yet.  Only the packed keys
        are exchanged; the whole rows meet the new keys."""
        rows = candidates.withColumn("_bucket", bucket_of(self.key, self.store.buckets))
        stored = self.stored(run_id, self.opened(rows, run_id))
        if stored is None:
            return rows
        key = lambda df: df.select(packed(self.key).alias("_k0"))
        return _having(rows, stage(key(rows).join(key(stored), "_k0", "left_anti").distinct(), "new-keys"), self.key)

    def append(self, candidates: DataFrame, run_id: str) -> None:
        folder = f"{self.store.path(self.name)}/run={run_id}"
        _write(self.new_rows(candidates, run_id), folder)
        before = self.store.latest(f"{self.name}/sketch", run_id)
        if self.store.has_files(folder):
            sketch = self._sketch_of(self.store.current(self.name, run_id, keep_bucket=True))
        else:                                          # nothing new
            sketch = self._sketch_of(candidates.limit(0).withColumn("_bucket", F.lit(0)))
        if before is not None:
            sketch = before.unionByName(sketch).groupBy("_bucket", "part", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        self.store.write_run(f"{self.name}/sketch", sketch.coalesce(max(1, self.store.buckets // 64)), run_id)


@dataclass
class BucketState:
    """A table with one current row a ``key``, rewritten bucket by bucket."""

    store: object
    name: str
    key: str

    def manifest(self, before: str | None = None) -> dict[int, str]:
        """Bucket -> run whose folder is live (one small row a bucket)."""
        rows = self.store.latest(f"{self.name}/manifest", before)
        return {} if rows is None else {r["bucket"]: r["live"] for r in rows.collect()}

    def folder(self, run_id: str) -> str:
        return f"{self.store.path(self.name)}/data/run={run_id}"

    def read(self, before: str | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """The current rows after the latest published run (before
        ``before``); ``_bucket`` is kept."""
        live = self.manifest(before)
        folders = [f"{self.folder(run)}/_bucket={b}" for b, run in sorted(live.items()) if buckets is None or b in set(buckets)]
        if not folders:
            return None
        base = f"{self.store.path(self.name)}/data"
        return self.store.spark.read.option("basePath", base).parquet(*folders).drop("run")

    def write(self, run_id: str, rows: DataFrame) -> None:
        """``rows`` (with ``_bucket``): the whole content of every bucket
        that changed; the other buckets stay as they are."""
        _write(rows, self.folder(run_id))
        changed = self.store.spark.read.parquet(self.folder(run_id)) if self.store.has_files(self.folder(run_id)) else None
        live = self.manifest(run_id) | ({} if changed is None else {b: run_id for b in _buckets(changed)})
        rows = self.store.spark.createDataFrame(sorted(live.items()), "bucket int, live string").coalesce(1)
        self.store.write_run(f"{self.name}/manifest", rows, run_id)


def append_versions(store, name: str, key: str, source: DataFrame, run_id: str) -> None:
    """A satellite's run: rows of ``source`` whose hashdiff differs from the
    key's latest one are appended to the history ``<name>/run=<id>``; the
    latest versions ``<name>/current`` are rewritten in the buckets that
    changed.  The history is not read."""
    state = BucketState(store, f"{name}/current", key)
    rows = source.withColumn("_bucket", bucket_of(key, store.buckets))
    latest = state.read(run_id, _buckets(rows)) if state.manifest(run_id) else None
    delta = rows if latest is None else _changed(rows, key, latest)
    store.write_run(name, delta.drop("_bucket").select(*source.columns), run_id)
    newest = lambda df: df.groupBy("_bucket", packed(key).alias("_k0")).agg(
        F.max(F.struct("load_dts", packed("hashdiff").alias("diff"))).alias("v")).select(
        "_bucket", unpacked("_k0").alias(key), "v.load_dts", unpacked("v.diff").alias("hashdiff"))
    columns = ["_bucket", key, "load_dts", "hashdiff"]
    delta = store.current(name, run_id).select(bucket_of(key, store.buckets).alias("_bucket"), *columns[1:])
    if latest is not None:
        marks = Marks(delta.select(packed(key).alias("_k0")))
        touched = latest.select(*columns).withColumn("_k0", packed(key)) \
            .join(F.broadcast(delta.select("_bucket").distinct()), "_bucket", "left_semi")   # a row a bucket
        # a key that is not marked keeps its version; the others' are compared
        kept, met = (marks.marked(touched, yes).drop("_k0") for yes in (False, True))
        state.write(run_id, kept.unionByName(newest(met.unionByName(delta))))
        return
    state.write(run_id, newest(delta))
