"""Key construction (K1-K4): all built-in column expressions, so they stay
inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the public surrogate-key convention ---------------------
# Each part is cast to text, a NULL part becomes this marker, parts are
# joined by "-" and the result is md5-hashed.
SURROGATE_NULL_MARKER = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
# Hashdiff convention: NULL -> '' and parts joined by "|".
HASHDIFF_SEPARATOR = "|"
# Marks packed text that is no digest (17 characters).
NOT_A_DIGEST = "-not-a-hex-digest"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """K1: md5 of the text form of each part, NULLs replaced by a marker.

    Only hash strings, integers, decimals and dates: the text of a double
    differs between engines."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def guarded_key(guard, *cols) -> Column:
    """K3: surrogate key, but NULL when the natural key ``guard`` is NULL."""
    return F.when(_col(guard).isNotNull(), surrogate_key(*cols))


def date_key(d) -> Column:
    """K2: YYYYMMDD integer of a date (NULL stays NULL)."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def hashdiff(*cols) -> Column:
    """K4: md5 of the parts joined by '|', NULL parts as ''."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(HASHDIFF_SEPARATOR, *parts))


def packed(digest) -> Column:
    """A hex digest as its 16 bytes, any other text as itself and a mark of 17
    characters (so the two never meet), NULL as no bytes."""
    c = _col(digest)
    other = F.encode(F.concat(c, F.lit(NOT_A_DIGEST)), "utf-8")
    return F.coalesce(F.when(is_digest(c), F.unhex(c)).otherwise(other), F.lit(b""))


def unpacked(packed_digest) -> Column:
    """The text that ``packed`` took."""
    c = _col(packed_digest)
    size = F.octet_length(c)
    other = F.decode(F.substring(c, F.lit(1), size - len(NOT_A_DIGEST)), "utf-8")
    return F.when(size == 16, F.lower(F.hex(c))).when(size > 16, other)


def is_digest(c: Column) -> Column:
    """32 digits in lower-case hex (a regular expression takes several times as long)."""
    return (F.octet_length(c) == 32) & (F.lower(F.hex(F.unhex(c))) == c)
