"""Daily open/high/low/close bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.time import utc_datetime, utc_day


# Sums are taken in decimals of this type, so that they do not depend on the order of the
# rows. Ten places after the point; a sum beyond 28 places before it is an error.
EXACT = "decimal(38, 10)"


def _exact_sum(column: str):
    """Sum of doubles, rounded once at the end; null if there are none. Not-a-number and
    infinite values count as missing."""
    return F.sum(F.col(column).cast(EXACT)).cast("double")


def with_calendar(ticks: DataFrame) -> DataFrame:
    """Add `datetime` (UTC wall clock) and `date` (UTC day) from epoch milliseconds."""
    return ticks.withColumns({
        "datetime": utc_datetime("timestamp"),
        "date": utc_day("timestamp"),
    })


def daily_bars(ticks: DataFrame) -> DataFrame:
    """One bar per series and UTC day.

    Volumes and market caps add up exactly, in any order of the rows and any layout.
    Open and close are the prices at the first and last instant of the day.
    All buffers are fixed width, so this is a hash aggregate with a partial step:
    a day or a series of any size leaves each task as one row. A `date` column at hand
    is taken as it is, so that ticks partitioned by (crypto_id, date) stay in place.
    """
    day = F.col("date") if "date" in ticks.columns else utc_day("timestamp").alias("date")
    return ticks.groupBy("crypto_id", day).agg(
        F.min_by("price", "timestamp").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "timestamp").alias("close"),
        _exact_sum("volume").alias("volume"),
        _exact_sum("market_cap").alias("_caps"),
        F.count(F.col("market_cap").cast(EXACT)).alias("_with_cap"),
        F.count(F.lit(1)).alias("data_points"),
    ).select(
        "crypto_id", "date", "open", "high", "low", "close", "volume",
        F.expr("round(_caps / nullif(_with_cap, 0), 0)").alias("market_cap"), "data_points")


# A stretch of time within a day for which ticks are rolled up before bars are put together.
SLICE_MS = 3_600_000


def time_slice(ms: str = "timestamp"):
    """Number of the slice an instant lies in; a slice lies in one day."""
    return F.floor(F.col(ms) / F.lit(SLICE_MS))


def partial_bars(ticks: DataFrame) -> DataFrame:
    """Mergeable states of bars, one per series and slice of ticks with a `slice` column.

    A state has the first and last instant with their prices, the extremes, and exact sums
    and counts. Ticks partitioned by (crypto_id, slice) stay in place.
    """
    return ticks.groupBy("crypto_id", "slice").agg(
        F.min("timestamp").alias("first_at"), F.min_by("price", "timestamp").alias("first"),
        F.max("timestamp").alias("last_at"), F.max_by("price", "timestamp").alias("last"),
        F.max("price").alias("high"), F.min("price").alias("low"),
        F.sum(F.col("volume").cast(EXACT)).alias("volumes"),
        F.sum(F.col("market_cap").cast(EXACT)).alias("caps"),
        F.count(F.col("market_cap").cast(EXACT)).alias("with_cap"),
        F.count(F.lit(1)).alias("ticks"))


def merge_bars(partial: DataFrame) -> DataFrame:
    """Daily bars from states of `partial_bars`, of which a day may have any number.

    The same bars as `daily_bars` of the ticks behind them. States partitioned by crypto_id
    stay in place.
    """
    return partial.withColumn("date", utc_day("first_at")).groupBy("crypto_id", "date").agg(
        F.min_by("first", "first_at").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("last", "last_at").alias("close"), F.sum("volumes").cast("double").alias("volume"),
        F.sum("caps").cast("double").alias("_caps"), F.sum("with_cap").alias("_with_cap"),
        F.sum("ticks").alias("data_points"),
    ).select(
        "crypto_id", "date", "open", "high", "low", "close", "volume",
        F.expr("round(_caps / nullif(_with_cap, 0), 0)").alias("market_cap"), "data_points")


def bar_counts(bars: DataFrame) -> DataFrame:
    """One row: number of bars and of ticks behind them."""
    return bars.agg(
        F.count(F.lit(1)).alias("bars"),
        F.coalesce(F.sum("data_points"), F.lit(0)).alias("ticks"),
    )
