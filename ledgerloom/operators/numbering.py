"""K5: row number within a natural grain, without one task per hot group.

``row_number() over (partition by g order by o1, o2, ...)`` puts every row of
a group into one task.  When the grain has a hot value (e.g. all NULL ids of
a tenant coalesced into one key, a third of the data) that task holds a
third of the table.  The exact distributed form used here, for every table:

    rn(row) = rows of g in earlier ranges
              + row_number() over (partition by g, range order by o1, o2, ...)

The ranges come from a sample of whole positions (g, o1, o2, ...): a grain
that is met more than once is cut at its sampled positions, so the pieces of
a grain follow its share of the rows, whatever columns tell its rows apart.
The cuts are written once, so the rows and the counts read the same ones; any
cuts give the same numbers.  The rows are exchanged once, on (g, range), and
the rows of earlier ranges are a small sum over the cut grains only.

A row that is alone in its grain has number 1 whatever its order columns hold.
The grains that are met again are found by an exchange of their hashes and
marked in a broadcast bitmap; while they fit it, only their rows, and the few
that share a bit with them, are exchanged and sorted.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.tables import stage


@dataclass(frozen=True)
class Order:
    """One ORDER BY item: expression, direction and explicit NULL placement."""

    expr: Column | str
    ascending: bool = True
    nulls_last: bool = True

    def column(self, c: Column | None = None) -> Column:
        c = c if c is not None else (F.col(self.expr) if isinstance(self.expr, str) else self.expr)
        if self.ascending:
            return c.asc_nulls_last() if self.nulls_last else c.asc_nulls_first()
        return c.desc_nulls_last() if self.nulls_last else c.desc_nulls_first()


def _expr(e) -> Column:
    return F.col(e) if isinstance(e, str) else e


#: Sampled positions: this many, or so many for each shuffle partition.
MARKS, MARKS_A_PARTITION = 128, 8
#: Words of 64 bits in the bitmap of the grains with more than one row, which
#: has eight bits a grain, four at least.
WORDS = 4_000_000
#: Children of a node in the tree of a grain's ranges.
FAN = 12


def _rising(e: Column, dtype: T.DataType, ascending: bool) -> Column | None:
    """A value that rises along the order; None if there is none."""
    if ascending:
        return e
    if isinstance(dtype, T.DateType):
        return -F.unix_date(e)
    if isinstance(dtype, T.TimestampType):
        return -F.unix_micros(e)
    if isinstance(dtype, T.TimestampNTZType):
        return -F.unix_micros(e.cast("timestamp"))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return -e.cast("decimal(20,0)")
    if isinstance(dtype, T.NumericType):
        return -e
    return None


def _position(base: DataFrame, order: list[Order], depth: int | None = None) -> Column:
    """A struct that compares as the first ``depth`` order items do: for each
    whether it is NULL (placed first or last) and its value.  It ends before a
    descending item of a type that has no opposite (a string); rows that are
    equal up to there stay in one range."""
    parts = []
    for i, o in enumerate(order[:depth]):
        e = _expr(o.expr)
        value = _rising(e, base.select(e).schema[0].dataType, o.ascending)
        if value is None:
            break
        parts += [(e.isNull() if o.nulls_last else e.isNotNull()).alias(f"n{i}"), value.alias(f"v{i}")]
    return F.struct(*parts) if parts else F.struct(F.lit(0).alias("n0"), F.lit(0).alias("v0"))


def _cuts(rows: DataFrame, order: list[Order], draw, size: int | None = None) -> tuple[DataFrame, int, int]:
    """The ranges of every grain whose rows were drawn more than once: (_h,
    fine, lo, hi), numbered from 0 and cut at the sampled positions, ``lo``
    inclusive, ``hi`` exclusive, NULL for open ends; how many order items the
    positions hold (the fewest that tell the sampled ones apart, so the other
    columns are not read again); the most ranges of a grain (0: nothing to
    cut).  The sample has about ``MARKS`` rows whatever the table's ``size``
    (its rows, about; counted if it is not known)."""
    spark = rows.sparkSession
    drawn = max(MARKS, MARKS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    sample = draw(min(1.0, drawn / max(rows.count() if size is None else size, 1))).select("_h", _position(rows, order).alias("at"))
    # exchanged, not coalesced: every task draws from its own part of the rows
    sample = stage(sample.repartition(1), "numbering-sample")
    met = sample.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("_h"))).where("n > 1").select("_h", "at")
    found = [(r["_h"], *r["at"]) for r in met.collect()]
    if not found:
        return sample, 0, 0
    names = sample.schema["at"].dataType.names
    told = [len({at[:1 + 2 * k] for at in found}) for k in range(len(names) // 2 + 1)]
    depth = max(1, told.index(told[-1]))
    grain = Window.partitionBy("_h").orderBy("lo")
    marks = met.select("_h", F.struct(*[F.col(f"at.{n}").alias(n) for n in names[:2 * depth]]).alias("lo")).distinct()
    ranges = marks.withColumns({"fine": F.row_number().over(grain), "hi": F.lead("lo").over(grain)})
    first = ranges.where("fine = 1").select("_h", F.lit(0).alias("fine"), F.lit(None).cast(
        marks.schema["lo"].dataType).alias("lo"), F.col("lo").alias("hi"))
    most = max(Counter(at[0] for at in found).values()) + 1
    return stage(first.unionByName(ranges).coalesce(1), "numbering-cuts"), depth, most


def _ranged(rows: DataFrame, cuts: DataFrame, most: int, at: Column) -> DataFrame:
    """``rows`` with ``_b``, the range of its grain that holds ``at`` (-1 in a
    grain without cuts).  The ranges form a tree of ``FAN`` children a node;
    a row goes down by one join a level and meets ``FAN`` nodes in each.  No
    table has more rows than the sample, hence the broadcasts."""
    out, levels = rows.withColumns({"_at": at, "_b": F.lit(0)}), 1
    while FAN ** levels < most:
        levels += 1
    for level in reversed(range(levels)):
        nodes = cuts.groupBy(F.col("_h").alias("_nh"), F.floor(F.col("fine") / FAN ** level).cast("int").alias("_node")) \
            .agg(F.min_by("lo", "fine").alias("_lo"), F.max_by("hi", "fine").alias("_hi")) \
            .withColumn("_up", F.floor(F.col("_node") / FAN).cast("int"))
        inside = (F.col("_lo").isNull() | (F.col("_lo") <= F.col("_at"))) & (F.col("_hi").isNull() | (F.col("_at") < F.col("_hi")))
        out = out.join(F.broadcast(nodes), (F.col("_h") == F.col("_nh")) & (F.col("_b") == F.col("_up")) & inside, "left") \
            .withColumn("_b", F.col("_node")).drop("_nh", "_node", "_up", "_lo", "_hi")
    return out.withColumn("_b", F.coalesce("_b", F.lit(-1))).drop("_at")


def row_in_grain(df: DataFrame, partition: list, order: list[Order], out: str = "_row_in_grain",
                 plain: bool = False, draw=None, alone_as: str | None = None) -> DataFrame:
    """Append ``out`` = row number (bigint) of each row inside its grain
    ``partition`` under ``order``; ``plain=True`` gives the single-window form
    (for comparison).  Window specs start with a 64-bit hash of their keys,
    so Spark's prefix sort resolves comparisons on one long.  The sample is
    drawn when this function is called; ``draw(fraction)`` may give a random
    part of the rows of ``df`` where that is cheaper than ``df.sample``.
    ``alone_as`` names a column that is true for rows known to be alone in
    their grain (others may be alone too)."""
    gcols = ["_g"]                     # one struct: NULLs in it equal each other, in joins too
    grained = lambda d: d.select("*", F.struct(*[_expr(p).alias(f"g{i}") for i, p in enumerate(partition)]).alias("_g"))
    keyed = lambda d: grained(d).withColumn("_h", F.xxhash64(*gcols))
    by = [o.column() for o in order]
    said = lambda d, yes: d.withColumn(alone_as, F.lit(yes)) if alone_as else d
    if plain:
        w = Window.partitionBy(*gcols).orderBy(*by)
        return said(grained(df).withColumn(out, F.row_number().over(w).cast("bigint")).drop(*gcols), False)
    rows = keyed(df)
    shared = stage(rows.groupBy("_h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "numbering-shared")
    n, size = shared.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    part_of = lambda part: keyed((draw or df.sample)(part))
    if n > 16 * WORDS:
        return said(_numbered(rows, gcols, order, by, out, part_of), False)
    place = f"pmod(_h, {64 * min(WORDS, n // 8 + 1)}L)"
    word, bit = F.expr(f"{place} div 64").alias("_w"), f"shiftleft(1L, cast({place} % 64 as int))"
    marked = F.broadcast(stage(shared.groupBy(word).agg(F.bit_or(F.expr(bit)).alias("_bits")), "numbering-bits"))
    met = lambda d, yes: d.withColumn("_w", word).join(marked, "_w", "left") \
        .where(F.expr(f"(coalesce(_bits, 0L) & {bit}) {'!=' if yes else '='} 0")).drop("_w", "_bits")
    alone = met(rows, False).drop("_h", *gcols).withColumn(out, F.lit(1).cast("bigint"))
    numbered = _numbered(met(rows, True), gcols, order, by, out, lambda part: met(part_of(part), True), size)
    return said(alone, True).unionByName(said(numbered, False))


def _numbered(rows: DataFrame, gcols: list[str], order: list[Order], by: list[Column], out: str, draw,
              size: int | None = None) -> DataFrame:
    """The numbers of rows that carry their grain (``gcols``) and its hash."""
    cuts, depth, most = _cuts(rows, order, draw, size)
    if not most:                       # no grain was met twice: none to cut
        w = Window.partitionBy("_h", *gcols).orderBy(*by)
        return rows.withColumn(out, F.row_number().over(w).cast("bigint")).drop("_h", *gcols)
    keys, at = ["_h", *gcols, "_b"], _position(rows, order, depth)
    numbered = _ranged(rows, cuts, most, at).withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
    cut = rows.join(F.broadcast(cuts.select("_h").distinct()), "_h", "left_semi")
    counts = _ranged(cut, cuts, most, at).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_h", *gcols).orderBy("_b")) - F.col("_n")
    offsets = counts.select(*keys, before.alias("_before"))
    return numbered.join(offsets, keys, "left") \
        .withColumn(out, F.coalesce("_before", F.lit(0)) + F.col("_rn")).drop(*keys, "_before", "_rn")
