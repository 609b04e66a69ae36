"""Declarative data-quality tests.

A test is a spec (kind, table, column(s), severity, optional row filter);
``run_tests`` evaluates a suite and returns one row per test:
``(test_name, table_name, severity, failures, status)``.  All tests of a table
that is computed as it is read come from one scan and one exchange; on stored
tables column checks (not_null, accepted_values) come from one aggregate row,
uniqueness is a group-by with partial aggregation and relationships are a
``left_anti`` join on the key.  ``warn`` failures do not fail a build.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import is_digest
from ..plans.tables import stage

COLUMN_KINDS = ("not_null", "accepted_values")
KINDS = ("not_null", "unique", "accepted_values", "relationships", "unique_combination_of_columns")


@dataclass(frozen=True)
class DataTest:
    kind: str
    table: str
    columns: tuple[str, ...]
    severity: str = "error"
    where: str | None = None            # SQL predicate restricting the tested rows
    values: tuple[str, ...] = ()        # accepted_values
    to: str | None = None               # relationships: parent table
    field: str | None = None            # relationships: parent column
    label: str = ""

    @property
    def name(self) -> str:
        if self.label:
            return self.label
        return f"{self.kind}_{self.table}_{'__'.join(self.columns)}"


def _rows(df: DataFrame, t: DataTest) -> DataFrame:
    return df.where(F.expr(t.where)) if t.where else df


def _failure_count(tables: dict[str, DataFrame], t: DataTest) -> DataFrame:
    df = _rows(tables[t.table], t)
    if t.kind in ("unique", "unique_combination_of_columns"):
        cols = list(t.columns)
        nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]) if t.kind == "unique" else F.lit(True)
        dup = df.where(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        return dup.agg(F.count(F.lit(1)).alias("failures"))
    if t.kind == "relationships":
        c = t.columns[0]
        parent = tables[t.to].select(F.col(t.field).alias(c)).distinct()
        # a row a value: few values of many rows do not cross the shuffle row by row
        orphans = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n")).join(parent, c, "left_anti")
        return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))
    raise ValueError(t.kind)


def _batched_column_checks(tables: dict[str, DataFrame], tests: list[DataTest]) -> list[DataFrame]:
    """All not_null / accepted_values tests of a table from one aggregate row
    (one scan), unpivoted to a row per test; a test's row filter is part of
    its condition."""
    out = []
    groups: dict[str, list[DataTest]] = {}
    for t in tests:
        groups.setdefault(t.table, []).append(t)
    for table, ts in groups.items():
        counts = []
        for t in ts:
            c = F.col(t.columns[0])
            bad = c.isNull() if t.kind == "not_null" else (c.isNotNull() & ~c.isin(list(t.values)))
            if t.where:
                bad = F.coalesce(F.expr(t.where), F.lit(False)) & bad
            counts.append(F.struct(F.lit(t.name).alias("test_name"), F.count_if(bad).alias("failures")))
        out.append(tables[table].agg(F.array(*counts).alias("tests")).select(F.inline("tests")))
    return out


#: Types whose values equal each other exactly if their bytes do.
EXACT = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType(), T.TimestampType(),
         T.TimestampNTZType(), T.StringType())


def _types(df: DataFrame, columns) -> list[T.DataType]:
    return [df.schema[c].dataType for c in columns]


def _by_bytes(tables: dict[str, DataFrame], t: DataTest) -> bool:
    own = _types(tables[t.table], t.columns)
    return all(x in EXACT for x in own) and (not t.to or _types(tables[t.to], [t.field]) == own)


def _bytes(c: Column, dtype: T.DataType) -> Column:
    """A value as bytes, other bytes for another value.  A digest in hex takes
    16; any other text is marked and never has that length."""
    if isinstance(dtype, T.TimestampType):
        c = F.unix_micros(c)
    text = c.cast("string").cast("binary")
    if not isinstance(dtype, T.StringType):
        return text
    mark = [F.unhex(F.lit(x)) for x in ("01", "02")]
    return (F.when(is_digest(c), F.unhex(c))
            .when(F.octet_length(c) == 15, F.concat(mark[1], text, mark[1])).otherwise(F.concat(mark[0], text)))


def _key(t: DataTest) -> Column:
    """The key of a test from its columns' bytes (``_b_<column>``)."""
    parts = [F.col(f"_b_{c}") for c in t.columns]
    if t.kind != "unique_combination_of_columns" and len(parts) == 1:
        return parts[0]
    # each part behind its length, so no two rows of parts read alike
    sized = [F.coalesce(F.concat(F.octet_length(p).cast("string").cast("binary"), F.lit(":").cast("binary"), p),
                        F.lit("-").cast("binary")) for p in parts]
    return F.concat(*sized)


#: Column checks in one mask of a row's failures.
MASK = 60


def _places(tests: list[DataTest]) -> tuple[list[tuple[int, int]], dict[tuple, int]]:
    """(family, slot) of every test, and the families.  The tests that want a
    value in one parent column are a family: its keys are in slot 0, those of
    each test in a slot of its own, and a test that wants the parent column
    unique takes slot 0 too.  Other key tests are families of one.  Column
    checks are bits (slots) of the mask of their table."""
    families: dict[tuple, int] = {}
    slots: dict[int, int] = {}
    out: list = [None] * len(tests)

    def place(i: int, name: tuple, first: int | None = None):
        f = families.setdefault(name, len(families))
        slots[f] = slots.get(f, -1 if first is None else first - 1) + 1
        out[i] = (f, slots[f])
    for i, t in enumerate(tests):
        if t.kind == "relationships":
            place(i, ("parent", t.to, t.field), 1)
    checks: dict[str, int] = {}
    for i, t in enumerate(tests):
        parent = ("parent", t.table, t.columns[0])
        if t.kind == "unique" and len(t.columns) == 1 and not t.where and parent in families:
            out[i] = (families[parent], 0)
        elif t.kind in COLUMN_KINDS:
            checks[t.table] = checks.get(t.table, -1) + 1
            place(i, ("mask", t.table, checks[t.table] // MASK))
        elif t.kind != "relationships":
            place(i, ("own", i))
    return out, families


def _marks(tables: dict[str, DataFrame], table: str, tests: list[DataTest], places, families) -> DataFrame:
    """All that the tests need of a table, from one scan: (family, slot, key),
    a row a value of its keys, and a row a row that fails column checks."""
    df = tables[table]
    out, masks, keys, parents = [], {}, {}, set()

    def mark(when: Column, family: int, slot: int, key: Column):
        out.append(F.when(when, F.struct(F.lit(family).alias("family"), F.lit(slot).alias("slot"), key.alias("key"))))
    for t, (family, slot) in zip(tests, places):
        if t.table == table:
            counted = F.coalesce(F.expr(t.where), F.lit(False)) if t.where else F.lit(True)
            c = F.col(t.columns[0])
            if t.kind in COLUMN_KINDS:
                bad = c.isNull() if t.kind == "not_null" else c.isNotNull() & ~c.isin(list(t.values))
                masks.setdefault(family, []).append(F.when(counted & bad, F.lit(1 << slot).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
            elif slot or families.get(("parent", table, t.columns[0])) != family:     # else the parent's own mark serves
                keys.update(dict.fromkeys(t.columns))
                if t.kind != "unique_combination_of_columns":
                    counted = reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in t.columns], counted)
                mark(counted, family, slot, _key(t))
        if t.to == table and family not in parents:
            parents.add(family)
            keys[t.field] = None
            mark(F.col(t.field).isNotNull(), family, 0, F.col(f"_b_{t.field}"))
    for family in masks:
        mark(F.col(f"_m_{family}") != 0, family, 0, F.col(f"_m_{family}").cast("string").cast("binary"))
    every = {f"_m_{f}": reduce(lambda a, b: a.bitwiseOR(b), bits) for f, bits in masks.items()}
    every |= {f"_b_{c}": _bytes(F.col(c), _types(df, [c])[0]) for c in keys}
    return df.withColumns(every).select(F.explode(F.array(*out)).alias("m")).where("m is not null").select("m.*")


def _counts_of_one_scan(tables: dict[str, DataFrame], tests: list[DataTest]) -> DataFrame:
    """The failures of tests whose tables are computed as they are read: every
    table is scanned once for all its tests and written nowhere, and one
    exchange carries a row a family and value, digests in half their text."""
    places, families = _places(tests)
    names = dict.fromkeys(n for t in tests for n in (t.table, t.to) if n)
    marks = reduce(lambda a, b: a.unionByName(b), [_marks(tables, n, tests, places, families) for n in names])
    masked = [f for name, f in families.items() if name[0] == "mask"]
    most = max(slot for t, (_, slot) in zip(tests, places) if t.kind not in COLUMN_KINDS) if len(masked) < len(families) else 0
    values = marks.groupBy("family", "key").agg(*[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(most + 1)])
    mask = F.when(F.col("family").isin(masked), F.col("key").cast("string").cast("bigint"))
    found = values.groupBy("family", mask.alias("mask")).agg(
        F.sum("n0").alias("rows"), F.count_if(F.col("n0") > 1).alias("twice"),
        *[F.sum(F.when(F.col("n0") == 0, F.col(f"n{i}")).otherwise(0)).alias(f"o{i}") for i in range(1, most + 1)])
    failed = []
    for i, (t, (family, slot)) in enumerate(zip(tests, places)):
        n = (F.when(F.col("mask").bitwiseAND(F.lit(1 << slot).cast("bigint")) != 0, F.col("rows")) if t.kind in COLUMN_KINDS
             else F.col("twice") if t.kind.startswith("unique") else F.col(f"o{slot}"))
        failed.append(F.when(F.col("family") == family, F.struct(F.lit(i).alias("test"), n.alias("n"))))
    counts = found.select(F.explode(F.array(*failed)).alias("m")).where("m is not null").groupBy("m.test").agg(F.sum("m.n").alias("failures"))
    names = marks.sparkSession.createDataFrame([(i, t.name) for i, t in enumerate(tests)], "test int, test_name string")
    return names.join(F.broadcast(counts), "test", "left").select("test_name", F.coalesce("failures", F.lit(0)).alias("failures"))


def run_tests(tables: dict[str, DataFrame], tests: list[DataTest], materialise: bool = True) -> DataFrame:
    """Evaluate a suite.  With ``materialise`` the tables are computed as they
    are read: all tests of a table come from one scan of it, and the suite's
    rows are written once to the shared folder if they take more than column
    checks.  Without, the tables are stored ones and each test of keys reads
    the columns it names."""
    once = [t for t in tests if t.kind in COLUMN_KINDS or _by_bytes(tables, t)] if materialise else []
    left = [t for t in tests if t not in once]
    parts = [_counts_of_one_scan(tables, once)] if once else []
    parts += _batched_column_checks(tables, [t for t in left if t.kind in COLUMN_KINDS])
    parts += [_failure_count(tables, t).select(F.lit(t.name).alias("test_name"), "failures")
              for t in left if t.kind not in COLUMN_KINDS]
    counts = reduce(lambda a, b: a.unionByName(b), parts)
    spark: SparkSession = counts.sparkSession
    meta = spark.createDataFrame([(t.name, t.table, t.severity) for t in tests],
                                 "test_name string, table_name string, severity string")
    res = F.broadcast(meta).join(counts, "test_name")
    status = (F.when(F.col("failures") == 0, "PASS")
              .when(F.col("severity") == "warn", "WARN").otherwise("FAIL"))
    out = res.select("test_name", "table_name", "severity",
                     F.col("failures").cast("bigint").alias("failures"), status.alias("status"))
    keys = any(t.kind not in COLUMN_KINDS for t in tests)
    return stage(out.coalesce(1), "test-results") if materialise and keys else out


def to_sql(t: DataTest) -> str:
    """The same test as one DuckDB statement returning its failure count."""
    where = f" WHERE ({t.where})" if t.where else ""
    src = f"(SELECT * FROM {t.table}{where})"
    if t.kind == "not_null":
        return f"SELECT count(*) FROM {src} WHERE {t.columns[0]} IS NULL"
    if t.kind == "accepted_values":
        vals = ", ".join("'" + v.replace("'", "''") + "'" for v in t.values)
        return f"SELECT count(*) FROM {src} WHERE {t.columns[0]} IS NOT NULL AND {t.columns[0]} NOT IN ({vals})"
    if t.kind == "unique":
        c = t.columns[0]
        return (f"SELECT count(*) FROM (SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} "
                f"HAVING count(*) > 1)")
    if t.kind == "unique_combination_of_columns":
        cols = ", ".join(t.columns)
        return f"SELECT count(*) FROM (SELECT {cols} FROM {src} GROUP BY {cols} HAVING count(*) > 1)"
    if t.kind == "relationships":
        c = t.columns[0]
        return (f"SELECT count(*) FROM {src} s WHERE s.{c} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {t.to} p WHERE p.{t.field} = s.{c})")
    raise ValueError(t.kind)


def suite_sql(tests: list[DataTest]) -> str:
    rows = "\nUNION ALL\n".join(
        f"SELECT '{t.name}' AS test_name, '{t.table}' AS table_name, '{t.severity}' AS severity, "
        f"CAST(({to_sql(t)}) AS BIGINT) AS failures" for t in tests)
    return (f"SELECT test_name, table_name, severity, failures, CASE WHEN failures = 0 THEN 'PASS' "
            f"WHEN severity = 'warn' THEN 'WARN' ELSE 'FAIL' END AS status FROM (\n{rows}\n)")
