"""Row rules for raw ticks: completeness, positive price, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.numeric import present
from barloom.functions.time import FIRST_MS, LAST_MS
from barloom.schema import CRITICAL, TICK_KEY


def _complete(df: DataFrame, columns: Sequence[str]) -> str:
    types = dict(df.dtypes)
    return " AND ".join(present(c, types[c]) for c in columns)


def drop_incomplete(ticks: DataFrame, columns: Sequence[str] = CRITICAL) -> DataFrame:
    """Drop rows where any of `columns` is null or NaN.

    Spelled as plain predicates, so that the null checks reach the Parquet scan.
    """
    return ticks.filter(_complete(ticks, columns))


def positive_price(ticks: DataFrame) -> DataFrame:
    """Keep rows with a price above zero."""
    return ticks.filter("price > 0")


IN_RANGE = f"timestamp BETWEEN {FIRST_MS} AND {LAST_MS}"


def in_range(ticks: DataFrame) -> DataFrame:
    """Keep rows whose instant lies in the years 1 to 9999; others have no day."""
    return ticks.filter(IN_RANGE)


def dedup_ticks(ticks: DataFrame, key: Sequence[str] = TICK_KEY) -> DataFrame:
    """One row per (timestamp, crypto_id): highest price, then volume, then market cap.

    The rank-1 filter becomes a group limit on both sides of the one shuffle, so
    a key copied any number of times leaves each task at most once. `key` may be
    widened by columns that follow from the tick key, to suit a partitioning at hand.
    """
    ranked = ["price", "volume", "market_cap"]
    rest = [c for c in ticks.columns if c not in ranked and c not in key]
    order = [F.col(c).desc_nulls_last() for c in ranked + rest if c in ticks.columns]
    best = Window.partitionBy(*key).orderBy(*order)
    return (
        ticks.withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


# Hash buckets that tick keys are counted by. A bucket is crowded if it has more than one in
# CROWD of all rows; there are fewer than CROWD such buckets.
KEY_BUCKETS, CROWD = 4096, 256


def key_bucket() -> Column:
    return F.pmod(F.xxhash64(*TICK_KEY), F.lit(KEY_BUCKETS))


def crowded(ticks: DataFrame) -> list[int]:
    """Hash buckets of tick keys that hold more than a share of 1 / CROWD of the rows.

    A tick with that many copies is in one of them. Reads the two columns of the key and
    shuffles KEY_BUCKETS counts a task; fewer than CROWD numbers reach the driver.
    """
    known = ticks.select(*TICK_KEY).filter(" AND ".join(f"{c} IS NOT NULL" for c in TICK_KEY))
    counts = known.groupBy(key_bucket().alias("bucket")).count()
    share = F.col("count") * CROWD > F.sum("count").over(Window.partitionBy(F.lit("all")))
    return sorted(r["bucket"] for r in counts.withColumn("crowded", share).filter("crowded").collect())


def valid_ticks(ticks: DataFrame) -> DataFrame:
    """Complete rows with an instant that has a day and a positive price."""
    return in_range(positive_price(drop_incomplete(ticks)))


def clean_ticks(ticks: DataFrame) -> DataFrame:
    """Complete rows with a positive price, one per key.

    The row filters come first: they reach the scan, and a key whose copies
    include an invalid one keeps its best valid copy.
    """
    return dedup_ticks(valid_ticks(ticks))


def cleaning_report(ticks: DataFrame) -> DataFrame:
    """One row: rows read, rows removed by each rule of `clean_ticks`, rows left.

    Counts per key first (combined map-side), then adds the keys up.
    """
    complete = _complete(ticks, CRITICAL)
    per_key = ticks.groupBy(*TICK_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"count_if({complete})").alias("complete"),
        F.expr(f"count_if({complete} AND {IN_RANGE})").alias("dated"),
        F.expr(f"count_if({complete} AND {IN_RANGE} AND price > 0)").alias("valid"),
    )

    def total(counted: str) -> Column:
        return F.expr(f"coalesce(sum({counted}), 0)")

    kept = "least(valid, 1)"
    return per_key.agg(
        total("n").alias("initial_rows"),
        total("n - complete").alias("incomplete_rows"),
        total("complete - dated").alias("out_of_range_rows"),
        total("dated - valid").alias("non_positive_rows"),
        total(f"valid - {kept}").alias("duplicate_rows"),
        total(kept).alias("final_rows"),
        total(f"n - {kept}").alias("removed_rows"),
    )
