"""Epoch milliseconds to UTC wall clock and back, whatever the session zone is.

None of these expressions passes through a zoned TIMESTAMP, so a job gives the
same days on every cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
# The instants of the years 1 to 9999, which dates and timestamps hold.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_datetime(ms: Column | str) -> Column:
    """Epoch milliseconds as TIMESTAMP_NTZ in UTC."""
    return F.timestamp_add("MILLISECOND", _col(ms), F.expr(_EPOCH))


def utc_day(ms: Column | str) -> Column:
    """UTC calendar day of epoch milliseconds (also before 1970)."""
    return F.date_from_unix_date(F.floor(_col(ms) / F.lit(MS_PER_DAY)).cast("int"))


def epoch_ms(ntz: Column | str) -> Column:
    """Epoch milliseconds of a UTC wall clock TIMESTAMP_NTZ.

    Whole days and the time within the day, both in integers. A thousand times the time
    of day, taken in seconds, is its milliseconds.
    """
    c = _col(ntz)
    day = c.cast("date")
    in_day = ((c - day.cast("timestamp_ntz")) * 1000).cast("interval second").cast("long")
    return F.unix_date(day) * F.lit(MS_PER_DAY).cast("long") + in_day
