"""Landing ingest of CSV drops.

One scan reads every CSV file of a drop folder positionally into
``_c0 .. _c{N-1}`` (N = widest feed) plus ``_corrupt_record``; each row is
routed to its feed by a regex over its file name (S3), rejected rows are
split off (S5), and the good rows are projected to the feed's column names
with the load stamp (S2) and appended to
``<root>/<shape>/load_id=/company=/dataset=`` (S6).  A load is seen once its
entry is in the manifest.  A single scan avoids reading the drop once per feed; short rows are
padded and long rows truncated to the feed's width, as the reference's
``error_on_column_count_mismatch = false`` does.

Reject rule (trap 14): Spark flags short and long rows in
``_corrupt_record`` too; only rows with an odd number of quote characters
(an unbalanced quote) are real parse failures.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.tables import remove, write
from ..schemas import FEEDS, Feed
from ..session import shared_path

# --- fixed values: CSV format of the landing files -------------------------
NULL_TOKENS = ["", "NULL", "null", "\\N"]
CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "header": "true",             # the first record of every file is skipped, whatever it holds
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "encoding": "UTF-8",          # invalid bytes become U+FFFD
    "recursiveFileLookup": "true",
    "pathGlobFilter": "*.{csv,csv.gz}",
}
MAX_COLUMNS = max(len(f.columns) for f in FEEDS)
RAW_COLUMNS = [f"_c{i}" for i in range(MAX_COLUMNS)]
CORRUPT = "_corrupt_record"


def raw_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS]
                        + [T.StructField(CORRUPT, T.StringType(), True)])


def logical_file_name(path: Column) -> Column:
    """The blob name a feed pattern is matched against: the file itself, or
    for a Spark-written folder ``x.csv/part-*.csv`` the folder name (any
    ``key=`` prefix removed, and the ending of a compressed file)."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    name = F.when(last.startswith("part-"), F.element_at(parts, -2)).otherwise(last)
    return F.regexp_replace(name, r"^[^=]*=|\.gz$", "")


def csv_options(multi_line: bool = False) -> dict[str, str]:
    """Reader options.  ``multi_line`` keeps line breaks inside quoted fields,
    at the price of one task per file (files are no longer split); without
    it such a record is quarantined as unbalanced quotes."""
    return {**CSV_OPTIONS, "multiLine": "true" if multi_line else "false"}


def with_origin(df: DataFrame) -> DataFrame:
    """Where each record comes from: logical file, full path, start of the
    read block and a number that rises within the block."""
    return df.withColumns({
        "_file": logical_file_name(F.col("_metadata.file_path")), "_path": F.col("_metadata.file_path"),
        "_block": F.col("_metadata.file_block_start"), "_row": F.monotonically_increasing_id()})


def scan_drop(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Positional all-string scan of every CSV under ``path``."""
    return with_origin(spark.read.schema(raw_schema()).options(**csv_options(multi_line)).csv(path))


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def feed_index() -> Column:
    """0-based index into ``FEEDS`` of the first pattern the file name fully
    matches (NULL when no feed claims the file)."""
    expr = None
    for i, f in enumerate(FEEDS):
        cond = F.col("_file").rlike(f"^(?:{f.file_regex})$")
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def route(raw: DataFrame) -> DataFrame:
    """S3: attach company / dataset / shape by file-name regex; files no
    feed claims are ignored."""
    routed = raw.withColumn("_feed", feed_index()).where(F.col("_feed").isNotNull())
    pos = F.col("_feed") + 1
    return routed.withColumns({
        "company": F.element_at(_lit_array([f.tenant for f in FEEDS]), pos),
        "dataset": F.element_at(_lit_array([f.dataset for f in FEEDS]), pos),
        "shape": F.element_at(_lit_array([f.shape for f in FEEDS]), pos),
    })


def quote_count(c: Column) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, '"', ""))


def is_rejected() -> Column:
    c = F.col(CORRUPT)
    return c.isNotNull() & (quote_count(c) % 2 == 1)


def null_token(c: Column) -> Column:
    return F.when(c.isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def to_landing(good: DataFrame, shape: str, run_ts) -> DataFrame:
    """Positional projection to the feed's columns + ``_loaded_at``.
    Feeds of one shape may differ in width (the MAIN_BOOK risk master has
    no ``productname``): a target column takes the position it has in the
    row's own feed layout."""
    feeds = [(i, f) for i, f in enumerate(FEEDS) if f.shape == shape]
    layouts: dict[tuple, list[int]] = {}
    for i, f in feeds:
        layouts.setdefault(f.columns, []).append(i)
    names = max(layouts, key=len)
    rows = good.where(F.col("shape") == shape)
    cols = []
    for name in names:
        positions = {cols_: (cols_.index(name) if name in cols_ else None) for cols_ in layouts}
        if len(set(positions.values())) == 1:
            p = next(iter(positions.values()))
            expr = F.col(f"_c{p}") if p is not None else F.lit(None).cast("string")
        else:
            expr = None
            for cols_, idx in layouts.items():
                p = positions[cols_]
                val = F.col(f"_c{p}") if p is not None else F.lit(None).cast("string")
                cond = F.col("_feed").isin(idx)
                expr = F.when(cond, val) if expr is None else expr.when(cond, val)
        cols.append(null_token(expr).alias(name))
    return rows.select("company", "dataset", *cols, F.lit(run_ts).cast("timestamp_ntz").alias("_loaded_at"))


def pipe_name(company: Column, dataset: Column) -> Column:
    return F.concat(F.lit("PIPE_"), company, F.lit("_"), F.upper(dataset))


def record_positions(staged: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` of a staged scan with ``_position``, the record's number in
    its file (the header is record 1): records of earlier blocks of the file
    plus the place inside the block."""
    blocks = staged.groupBy("_path", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_path").orderBy("_block")) - F.col("_n")
    blocks = blocks.select("_path", "_block", "_first", before.alias("_before"))
    return rows.join(blocks, ["_path", "_block"]).withColumn(
        "_position", F.col("_before") + F.col("_row") - F.col("_first") + 2)


def rejected_errors(staged: DataFrame) -> DataFrame:
    """S5 -> Q1 input: one error row per rejected record of a staged scan,
    keyed by the file's full path and the record's number in it, so equal
    bad lines stay apart and a re-seen record keeps its key."""
    bad = record_positions(staged, split(staged)[1])
    return bad.select(
        pipe_name(F.col("company"), F.col("dataset")).alias("pipe_name"),
        F.lit("Unbalanced quote: the field enclosure is not closed").alias("error"),
        F.col("_path").alias("file_name"),
        F.lit(None).cast("bigint").alias("line"),
        F.lit(None).cast("bigint").alias("character_pos"),
        F.lit(None).cast("bigint").alias("byte_offset"),
        F.lit("parsing").alias("category"), F.lit("100065").alias("code"), F.lit("22000").alias("sql_state"),
        F.lit(None).cast("string").alias("column_name"),
        F.col("_position").alias("row_number"),
        F.lit(None).cast("bigint").alias("row_start_line"),
        F.col(CORRUPT).alias("rejected_record"))


def split(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows)."""
    return routed.where(~is_rejected()), routed.where(is_rejected())


def read_routed(spark: SparkSession, drop: str, multi_line: bool = False) -> DataFrame:
    return route(scan_drop(spark, drop, multi_line))


def write_landing(df: DataFrame, root: str, shape: str, load_id: str) -> None:
    """``<root>/<shape>/load_id=<id>/company=/dataset=`` parquet.  One
    folder per load, overwritten when the same load is re-run, so a retried
    load (or a re-executed stream batch) never duplicates rows."""
    write(df, f"{root.rstrip('/')}/{shape}/load_id={load_id}", "company", "dataset")


#: Folder of the load manifest below a landing root.
LOADS = "_loads"


def committed_loads(spark: SparkSession, root: str) -> list[str]:
    """Ids of the loads that are complete: a load's entry in the manifest is
    its last write, and Spark marks a finished write with ``_SUCCESS``."""
    return sorted(name.split("=", 1)[1] for name in folder_names(spark, f"{root.rstrip('/')}/{LOADS}")
                  if "_SUCCESS" in folder_names(spark, f"{root.rstrip('/')}/{LOADS}/{name}"))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder (none if it is not there)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else []


def _committed_folders(spark: SparkSession, base: str, root: str, skip: str | None = None) -> list[str]:
    folders = [f"{base.rstrip('/')}/load_id={i}" for i in committed_loads(spark, root) if i != skip]
    return [f for f in folders if any(not n.startswith("_") for n in folder_names(spark, f))]


def read_landing(spark: SparkSession, root: str, shape: str) -> DataFrame:
    """All committed loads of one shape (landing form, ``load_id`` dropped)."""
    base = f"{root.rstrip('/')}/{shape}"
    folders = _committed_folders(spark, base, root)
    if not folders:
        names = max((f.columns for f in FEEDS if f.shape == shape), key=len)
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in [*names, "company", "dataset"])
                                     + ", _loaded_at timestamp_ntz")
    return spark.read.option("basePath", base).parquet(*folders).drop("load_id")


def read_quarantine(spark: SparkSession, root: str, quarantine_path: str, skip: str | None = None) -> DataFrame | None:
    """Rejected records of all committed loads (but ``skip``); None if there are none."""
    folders = _committed_folders(spark, quarantine_path, root, skip)
    return spark.read.option("basePath", quarantine_path).parquet(*folders).drop("load_id") if folders else None


def load_history(spark: SparkSession, root: str) -> DataFrame | None:
    """One row for every file of every committed load: load_id, file_name,
    company, dataset, row_count, error_count, status, last_load_time."""
    base = f"{root.rstrip('/')}/{LOADS}"
    folders = [f"{base}/load_id={i}" for i in committed_loads(spark, root)]
    return spark.read.option("basePath", base).parquet(*folders) if folders else None


def _files_of(staged: DataFrame, run_ts) -> DataFrame:
    rejected = F.count_if(is_rejected())
    files = staged.groupBy(F.col("_path").alias("file_name"), "company", "dataset").agg(
        F.count(F.lit(1)).alias("row_count"), rejected.alias("error_count"))
    status = F.when(F.col("error_count") == 0, "LOADED").when(F.col("error_count") < F.col("row_count"), "PARTIALLY_LOADED") \
        .otherwise("LOAD_FAILED")
    return files.select("*", status.alias("status"), F.lit(run_ts).cast("timestamp_ntz").alias("last_load_time"))


SHAPES = ["commissions", "valuations", "investment_transactions", "risk_transactions", "risk_policies"]


def land(routed: DataFrame, landing_root: str, quarantine_path: str, run_ts, load_id: str, shapes=SHAPES) -> None:
    """Land one routed scan: it is written once to the shared folder, every
    shape is written under ``landing_root`` from there, rejected records are
    captured (Q1 MERGE semantics against the other committed loads) under
    ``<quarantine_path>/load_id=<id>``, and the written scan is removed.  The
    load's files with their counts go into the manifest last, and readers open
    committed loads only: a load that dies half-way shows nothing, and its
    retry overwrites what it left."""
    from ..operators.quarantine import capture

    spark = routed.sparkSession
    folder = shared_path(spark, "routed", uuid.uuid4().hex)
    write(routed, folder)
    staged = spark.read.parquet(folder)
    try:
        good, _ = split(staged)
        for shape in shapes:
            write_landing(to_landing(good, shape, run_ts), landing_root, shape, load_id)
        existing = read_quarantine(spark, landing_root, quarantine_path, skip=load_id)
        new = capture(rejected_errors(staged), existing, F.lit(run_ts).cast("timestamp_ntz"))
        new.write.mode("overwrite").parquet(f"{quarantine_path.rstrip('/')}/load_id={load_id}")
        _files_of(staged, run_ts).write.mode("overwrite").parquet(f"{landing_root.rstrip('/')}/{LOADS}/load_id={load_id}")
    finally:
        remove(spark, folder)


def ingest_batch(spark: SparkSession, drop: str, landing_root: str, quarantine_path: str, run_ts,
                 load_id: str, shapes=SHAPES, multi_line: bool = False) -> None:
    """Load one drop folder: every shape landed, rejected rows quarantined."""
    land(read_routed(spark, drop, multi_line), landing_root, quarantine_path, run_ts, load_id, shapes)


# ------------------------------------------------------------------ writing drops
def file_prefix(tenant: str) -> str:
    return {"MAIN_BOOK": "main_book", "INDIGO_INSURANCE": "indigo", "HORIZON_ASSURANCE": "horizon"}[tenant]


def logical_name(feed: Feed) -> str:
    return f"fsp-{file_prefix(feed.tenant)}_{feed.dataset}.csv"


def write_drop(landing: DataFrame, shape: str, drop: str, upper_header: bool = False, compression: str = "none") -> None:
    """Write landing-form rows of one shape as CSV files named after their
    feed (``<drop>/_f=fsp-<tenant>_<dataset>.csv/part-*.csv``), header per
    part file, NULL as an empty field.  Feeds of different width are
    written separately so positions stay right.  A file written with
    ``compression="gzip"`` (``part-*.csv.gz``) is read by one task."""
    feeds = [f for f in FEEDS if f.shape == shape]
    widths = sorted({f.columns for f in feeds}, key=len)
    for cols in widths:
        group = [f for f in feeds if f.columns == cols]
        name = None
        for f in group:
            cond = (F.col("company") == f.tenant) & (F.col("dataset") == f.dataset)
            name = F.when(cond, F.lit(logical_name(f))) if name is None else name.when(cond, F.lit(logical_name(f)))
        out = landing.withColumn("_f", name).where(F.col("_f").isNotNull()).select(
            "_f", *[F.col(c).alias(c.upper() if upper_header else c) for c in cols])
        (out.write.mode("append").partitionBy("_f")
         .options(header="true", quote='"', escape='"', nullValue="", emptyValue='""', compression=compression)
         .csv(drop))
