"""Helpers shared by the corpus operators."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.tables import stage
from ..session import ensure_checkpoint_dir

__all__ = ["byte_slices", "pick", "stage", "prepare", "texts_of", "utf8_buffer", "mix64"]


_shipped: set[str] = set()
#: Rows and bytes of an Arrow batch sent to a Python worker; both sides of the
#: socket hold a batch, so this bounds an executor's memory outside the heap.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def prepare(spark) -> None:
    """Session settings every operator here relies on, and the package's own
    code for the Python workers, shipped once per application."""
    ensure_checkpoint_dir(spark)
    for name, value in BATCH.items():
        spark.conf.set(name, value)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        base = Path(tempfile.mkdtemp(prefix="ledgerloom-code-")) / package.name
        context.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Project ``df`` to the named input columns under the operator's own
    names, so extra columns (also ones that clash with names used inside an
    operator) never get into its plan."""
    return df.select(*[F.col(f"`{src}`").alias(name) for name, src in columns.items()])


def blank(column: str) -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` text bytes (one row
    at least), so working memory follows the limit and not the batch size."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's texts, null read as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def utf8_buffer(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes end to end, and the rows+1 offsets into them."""
    arr = pa.compute.fill_null(batch.column(column), "").cast(pa.large_binary())
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and odd multiplications), element-wise."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
