"""Which series, and how far back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.time import MS_PER_DAY
from barloom.schema import MAX_ID_LENGTH

# The two usual sizes of an ingest: (number of series, days of history).
SMALL_PROFILE = (5, 7)
FULL_PROFILE = (20, 365)

# A list of ids is broadcast only if a limit keeps it below this many bytes.
BROADCAST_BYTES = 8 * 1024 * 1024
_BYTES_PER_ID = 4 * MAX_ID_LENGTH + 32


def top_k(listing: DataFrame, k: int = FULL_PROFILE[0]) -> DataFrame:
    """The `k` largest listings by market cap, ties by id (a top-k heap per task).

    A market cap that is no number counts as missing, and comes last. Of several listings
    with one id the largest counts; listings without an id do not.
    """
    known = listing.filter(F.col("id").isNotNull()).withColumn(
        "market_cap", F.when(~F.isnan("market_cap"), F.col("market_cap")))
    rest = [c for c in listing.columns if c not in ("id", "market_cap")]
    best = F.max(F.struct("market_cap", *rest)).alias("best")
    one = known.groupBy("id").agg(best).select(
        *[F.col("id") if c == "id" else F.col(f"best.{c}") for c in listing.columns])
    return one.orderBy(F.desc_nulls_last("market_cap"), "id").limit(k)


def series_ids(listing: DataFrame) -> DataFrame:
    """The ids of a listing."""
    return listing.select("id")


def restrict_to(df: DataFrame, ids: DataFrame, on: str = "crypto_id",
                at_most: int | None = None) -> DataFrame:
    """Rows of `df` whose `on` is among `ids`.

    `at_most` is the limit `ids` was cut to. A list that provably fits is broadcast,
    and `df` is filtered without a shuffle. Without a bound Spark chooses the join by
    its own size estimate, and a hot id is split by the adaptive skew join.
    """
    keys = ids.select(F.col("id").alias(on))
    if at_most is not None and at_most * _BYTES_PER_ID <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    return df.join(keys, on, "left_semi")


def restrict_to_top_k(df: DataFrame, listing: DataFrame, k: int = FULL_PROFILE[0],
                      on: str = "crypto_id") -> DataFrame:
    """Rows of the `k` largest series."""
    return restrict_to(df, series_ids(top_k(listing, k)), on, at_most=k)


def lookback(ticks: DataFrame, days: int = FULL_PROFILE[1], until_ms: int | None = None) -> DataFrame:
    """Ticks of the last `days` days before `until_ms` (default: before the latest tick).

    With `until_ms` the bound is a literal and reaches the Parquet statistics at plan
    time; else it is a scalar subquery over the timestamp column alone.
    """
    ts = F.col("timestamp")
    if until_ms is not None:
        return ticks.filter((ts > until_ms - days * MS_PER_DAY) & (ts <= until_ms))
    latest = ticks.agg(F.max("timestamp")).scalar()
    return ticks.filter(ts > latest - days * MS_PER_DAY)


def lookup(ticks: DataFrame, series: list[str] | None = None, since_ms: int | None = None,
           until_ms: int | None = None) -> DataFrame:
    """Ticks of some series and of a stretch of time, both ends included; None is no bound.

    Plain predicates, which reach the scan: a clustered snapshot opens few files for them.
    """
    if series is not None:
        ticks = ticks.filter(F.col("crypto_id").isin(*series))
    if since_ms is not None:
        ticks = ticks.filter(F.col("timestamp") >= since_ms)
    if until_ms is not None:
        ticks = ticks.filter(F.col("timestamp") <= until_ms)
    return ticks
