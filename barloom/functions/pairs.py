"""Access to arrays of `[epoch ms, value]` pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The milliseconds of years 1 to 9999.
MIN_MS = -62_135_596_800_000
MAX_MS = 253_402_300_799_999


def pairs(name: str) -> Column:
    """The array, or an empty one where the document lacks the key."""
    c = F.col(name)
    return F.coalesce(c, F.array().cast("array<array<double>>"))


def value_at(array: Column, i: Column) -> Column:
    """Value of the i-th pair; null past the end."""
    return F.get(F.get(array, i), F.lit(1))


def is_point(p: Column) -> Column:
    """A pair of exactly two members."""
    return p.isNotNull() & (F.size(p) == 2)


def has_time(p: Column) -> Column:
    """The first member is an instant a calendar can show."""
    ms = F.get(p, F.lit(0))
    # NaN is the greatest double, so the range check turns it away as well.
    return F.coalesce(ms.between(float(MIN_MS), float(MAX_MS)), F.lit(False))


def has_value(p: Column) -> Column:
    """The pair has a second member (which may be null)."""
    return p.isNotNull() & (F.size(p) >= 2)
