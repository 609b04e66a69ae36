"""Null- and zero-guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num, den) -> Column:
    """num / den as double; NULL when den is NULL or 0 (no ANSI error)."""
    den = _col(den).cast("double")
    return F.when(den.isNotNull() & (den != 0), _col(num).cast("double") / den)


def pct_change(current, prior) -> Column:
    """(current - prior) / prior, guarded for a NULL or zero prior."""
    prior = _col(prior)
    return F.when(prior.isNotNull() & (prior != 0),
                  (_col(current) - prior).cast("double") / prior.cast("double"))
