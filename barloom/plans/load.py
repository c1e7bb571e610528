"""A snapshot of ticks to the tick table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from barloom.sinks.tables import append_ticks
from barloom.sources.snapshots import read_legacy_ticks, read_ticks


def load_snapshot(spark: SparkSession, raw_root: str, table: str, date: str | None = None,
                  on_conflict: str = "append", legacy: bool = False) -> int:
    """Append the snapshot of `date` (default: the latest); returns the rows added.

    Where there is no snapshot nothing is added.
    """
    read = read_legacy_ticks if legacy else read_ticks
    return append_ticks(read(spark, raw_root, date, on_empty="empty"), table, on_conflict)
