"""Ticks to daily metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.time import utc_day
from barloom.operators.bars import daily_bars, merge_bars, partial_bars, time_slice
from barloom.operators.cleaning import clean_ticks, crowded, dedup_ticks, in_range, key_bucket, valid_ticks
from barloom.operators.metrics import add_metrics
from barloom.plans.report import RunReport
from barloom.schema import TICK_KEY
from barloom.sinks.datasets import write_bars
from barloom.sources.snapshots import read_legacy_ticks, read_ticks

PREVIEW = ("crypto_id", "date", "close", "ma_7d", "change_1d_pct", "volatility_7d")

# How the ticks of a run are shuffled.
#   "spread"   by (timestamp, crypto_id), each task sending one copy of a key. No series,
#              day or group of copies can overload a task. Where bars far outnumber the
#              rows of a task, partial bars are about as many as ticks, and a second
#              shuffle of that size follows.
#   "sliced"   by (crypto_id, hour). Ticks are shuffled and sorted once and rolled up where they
#              land to states of bars; these are shuffled by crypto_id, where they become
#              bars and stay for the metrics. An hour of a series has at most 3.6 million
#              different instants. Ticks with very many copies are looked for first, in a
#              pass over the two columns of the key (see `crowded`), and are reduced map-side
#              as in "spread"; that branch is there only if there are such ticks.
#   "by_bar"   by (crypto_id, date). Ticks are shuffled once and rolled up where they
#              land; all copies of a bar's ticks meet in one task.
# A run over a snapshot takes "sliced" at every size: the pass for the copies reads two
# columns of Parquet files. The functions below take "spread" unless asked, for their ticks may
# be costly to compute twice. "by_bar" is for callers who know their bars.
LAYOUTS = ("sliced", "spread", "by_bar")


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Partitioned by the keys, to the session's number of shuffle partitions.

    As the number is given, adaptive execution puts no partitions together. It would go by
    compressed bytes, and a tick of a sparse series, its sort and its state take some forty
    times those of a task's memory.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def by_slice(ticks: DataFrame) -> DataFrame:
    """Valid ticks partitioned by (crypto_id, slice), those with very many copies reduced to one a key."""
    ticks = ticks.withColumn("slice", time_slice())
    buckets = crowded(ticks)
    valid = valid_ticks(ticks)
    if buckets:
        copied = key_bucket().isin(buckets)
        valid = valid.filter(~copied).unionByName(dedup_ticks(valid.filter(copied)))
    return _dealt(valid, "crypto_id", "slice")


def densest_bar(ticks: DataFrame) -> DataFrame:
    """One row: the number of raw rows behind the bar that has the most.

    Reads two columns and shuffles counts. Rows without an instant that has a day count for none.
    """
    per_bar = in_range(ticks).groupBy("crypto_id", utc_day("timestamp").alias("date")).count()
    return per_bar.agg(F.coalesce(F.max("count"), F.lit(0)).alias("rows"))


def clean_bars(ticks: DataFrame, layout: str = "spread") -> DataFrame:
    """Clean, then roll up to daily bars.

    Only the five columns the bars need are read and shuffled. All layouts give the
    same bars. "sliced" counts the keys (see `crowded`) when it is called.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout is one of {LAYOUTS}, not {layout!r}")
    needed = ticks.select("timestamp", "crypto_id", "price", "volume", "market_cap")
    if layout == "spread":
        return daily_bars(clean_ticks(needed))
    if layout == "sliced":
        states = partial_bars(dedup_ticks(by_slice(needed), (*TICK_KEY, "slice")))
        return merge_bars(_dealt(states, "crypto_id"))
    dated = valid_ticks(needed).withColumn("date", utc_day("timestamp"))
    in_place = _dealt(dated, "crypto_id", "date")
    return daily_bars(dedup_ticks(in_place, ("crypto_id", "date", "timestamp")))


def daily_metrics(ticks: DataFrame, layout: str = "spread", calendar: bool = False) -> DataFrame:
    """Clean, roll up to daily bars, add all metrics.

    After the ticks (see `LAYOUTS`) only bars or states of bars are shuffled, by crypto_id; a
    series has at most one bar and 24 states a day.
    """
    return add_metrics(clean_bars(ticks, layout), calendar)


def preview(metrics: DataFrame, rows: int = 15) -> DataFrame:
    """The first rows by (crypto_id, date), main columns."""
    return metrics.select(*PREVIEW).orderBy("crypto_id", "date").limit(rows)


def raw_preview(ticks: DataFrame, rows: int = 5) -> DataFrame:
    """The first raw ticks by key, whole rows; ties by price, volume and market cap."""
    return ticks.orderBy("crypto_id", "timestamp", "price", "volume", "market_cap").limit(rows)


def run_transform(spark: SparkSession, raw_root: str, out_root: str, run_date: str,
                  date: str | None = None, legacy: bool = False, layout: str = "sliced",
                  calendar: bool = False, ordered: bool = False, allow_empty: bool = False) -> RunReport:
    """Read a snapshot, write its daily metrics, report.

    An empty snapshot is an error unless `allow_empty`, so that it does not replace an
    earlier run by nothing. The raw count is read from the Parquet footers; the others come
    with the write.
    """
    read = read_legacy_ticks if legacy else read_ticks
    raw = read(spark, raw_root, date)
    loaded = raw.count()
    if not loaded and not allow_empty:
        raise ValueError(f"the snapshot in {raw_root} has no rows")
    metrics = daily_metrics(raw, layout, calendar)
    path, bars, ticks = write_bars(metrics, out_root, run_date, ordered)
    counts = {"raw": loaded, "removed": loaded - ticks, "clean": ticks, "bars": bars}
    return RunReport({"daily_prices": path}, counts)
