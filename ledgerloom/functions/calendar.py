"""Date helpers shared by dims, facts and marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_boundaries(start, end) -> Column:
    """``datediff('year', a, b)``: number of calendar-year boundaries crossed
    (not completed birthdays)."""
    return (F.year(_col(end)) - F.year(_col(start))).cast("int")
