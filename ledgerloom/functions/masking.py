"""Masking expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: roles that see raw PII, and the string mask -------------
PRIVILEGED_ROLES = ("FR_ENGINEER", "ACCOUNTADMIN")
STRING_MASK = "***MASKED***"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_string(c, role: str) -> Column:
    """G1: the value for a privileged role, else the mask (NULL included)."""
    return _col(c) if role in PRIVILEGED_ROLES else F.lit(STRING_MASK)


def mask_date(c, role: str) -> Column:
    """The value for a privileged role, else the first day of its year."""
    return _col(c) if role in PRIVILEGED_ROLES else F.trunc(_col(c), "year")
