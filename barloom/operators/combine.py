"""Concatenation of tick frames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def union_ticks(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, by column name; a column a frame lacks is null there."""
    result = None
    for frame in frames:
        result = frame if result is None else result.unionByName(frame, allowMissingColumns=True)
    if result is None:
        raise ValueError("no frames to combine")
    return result
