"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlens.functions.text import normalize

# ASCII unit separator: does not occur in names or addresses, so ("a|b", "c") and ("a", "b|c") differ
SEPARATOR = "\x1f"


def surrogate_key(*columns: Column) -> Column:
    """Non-negative 60-bit key of the columns in order; NULL counts as empty text.

    Derived from the data alone, so every table that refers to the same thing computes the same key
    without a lookup. ``xxhash64`` is not used: it skips NULLs, so ('a', NULL, 'b') would equal
    ('a', 'b').
    """
    text = F.concat_ws(SEPARATOR, *[F.coalesce(c, F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def normalized_key(*names: str) -> Column:
    """Key over named text columns after trimming and lower-casing each."""
    return surrogate_key(*[normalize(F.col(name)) for name in names])
