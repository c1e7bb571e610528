"""One query per operator. Each reads whole tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import barloom as b
from barloom.schema import METRICS
from workload import adapters as a
from workload.scratch import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Dates under which queries keep snapshots and runs.
OLDER, LATEST = "2024-01-15", "2024-01-31"
HALF_WAY_MS = 1_705_276_800_000  # 2024-01-15 00:00 UTC

# What queries show of a tick (the wall clock has queries of its own).
TICK = ("timestamp", "crypto_id", "price", "volume", "market_cap")


def _query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# Cleaning ---------------------------------------------------------------------------

@_query
def drop_incomplete(spark, sf):
    return b.drop_incomplete(a.dirty_ticks(spark, sf)).select(*TICK)


@_query
def positive_price(spark, sf):
    # NaN counts as a positive price until `drop_incomplete` has taken it out.
    return b.positive_price(b.drop_incomplete(a.dirty_ticks(spark, sf), ["price"])).select(*TICK)


@_query
def dedup_ticks(spark, sf):
    return b.dedup_ticks(b.drop_incomplete(a.dirty_ticks(spark, sf))).select(*TICK)


@_query
def clean_ticks(spark, sf):
    return b.clean_ticks(a.dirty_ticks(spark, sf)).select(*TICK)


@_query
def clean_ticks_by_part(spark, sf):
    return b.clean_ticks(a.ticks_by_part(spark, sf)).select(*TICK)


@_query
def cleaning_report(spark, sf):
    return b.cleaning_report(a.dirty_ticks(spark, sf))


# Bars -------------------------------------------------------------------------------

@_query
def tick_calendar(spark, sf):
    ticks = a.ticks_by_user(spark, sf).drop("datetime")
    return b.with_calendar(ticks).select("timestamp", "crypto_id", "datetime", "date")


@_query
def daily_ohlc(spark, sf):
    return b.daily_bars(a.ticks_by_type(spark, sf)).select(
        "crypto_id", "date", "open", "high", "low", "close", "data_points")


@_query
def daily_volume_cap(spark, sf):
    return b.clean_bars(a.dirty_ticks(spark, sf)).select(
        "crypto_id", "date", "volume", "market_cap", "data_points")


@_query
def daily_bars(spark, sf):
    return b.clean_bars(a.dirty_ticks(spark, sf))


@_query
def bar_counts(spark, sf):
    return b.bar_counts(b.clean_bars(a.ticks_by_part(spark, sf)))


# Metrics ----------------------------------------------------------------------------

def _user_bars(spark, sf):
    return b.clean_bars(a.ticks_by_user(spark, sf)).select("crypto_id", "date", "close")


@_query
def moving_averages(spark, sf):
    return b.moving_averages(_user_bars(spark, sf))


@_query
def lagged_closes(spark, sf):
    return b.lagged_closes(_user_bars(spark, sf))


@_query
def price_changes(spark, sf):
    return b.price_changes(_user_bars(spark, sf))


@_query
def volatility(spark, sf):
    return b.volatility(_user_bars(spark, sf))


@_query
def calendar_moving_averages(spark, sf):
    return b.moving_averages(_user_bars(spark, sf), calendar=True)


@_query
def calendar_price_changes(spark, sf):
    return b.price_changes(_user_bars(spark, sf), calendar=True)


@_query
def calendar_volatility(spark, sf):
    return b.volatility(_user_bars(spark, sf), calendar=True)


@_query
def daily_metrics(spark, sf):
    return b.daily_metrics(a.dirty_ticks(spark, sf))


@_query
def daily_metrics_by_user(spark, sf):
    return b.daily_metrics(a.ticks_by_user(spark, sf))


@_query
def daily_metrics_by_user_in_place(spark, sf):
    return b.daily_metrics(a.ticks_by_user(spark, sf), "by_bar")


@_query
def daily_metrics_by_type(spark, sf):
    return b.daily_metrics(a.ticks_by_type(spark, sf))


@_query
def daily_metrics_by_part(spark, sf):
    return b.daily_metrics(a.ticks_by_part(spark, sf))


@_query
def calendar_metrics_by_part(spark, sf):
    return b.daily_metrics(a.ticks_by_part(spark, sf), calendar=True)


@_query
def daily_metrics_unique_keys(spark, sf):
    # The events have one row per user and instant: nothing to drop.
    return b.daily_metrics(a.ticks_by_user(spark, sf))


@_query
def daily_metrics_in_place(spark, sf):
    return b.daily_metrics(a.dirty_ticks(spark, sf), "by_bar")


@_query
def daily_metrics_by_part_in_place(spark, sf):
    return b.daily_metrics(a.ticks_by_part(spark, sf), "by_bar")


@_query
def daily_metrics_sliced(spark, sf):
    return b.daily_metrics(a.dirty_ticks(spark, sf), "sliced")


@_query
def daily_metrics_by_part_sliced(spark, sf):
    return b.daily_metrics(a.ticks_by_part(spark, sf), "sliced")


@_query
def densest_bar(spark, sf):
    return b.densest_bar(a.dirty_ticks(spark, sf))


@_query
def metrics_preview(spark, sf):
    return b.preview(b.daily_metrics(a.ticks_by_user(spark, sf)), 15)


@_query
def daily_bars_fractional(spark, sf):
    return b.clean_bars(a.fractional_ticks(spark, sf))


@_query
def daily_metrics_fractional(spark, sf):
    return b.daily_metrics(a.fractional_ticks(spark, sf))


@_query
def raw_preview(spark, sf):
    return b.raw_preview(a.ticks_by_part(spark, sf)).select(*TICK)


# History documents ------------------------------------------------------------------

@_query
def explode_history(spark, sf):
    return b.explode_history(a.histories(spark, sf)).select(*TICK)


@_query
def explode_long_history(spark, sf):
    return b.explode_long_history(a.histories(spark, sf), 30).select(*TICK)


@_query
def history_points(spark, sf):
    return b.history_points(a.histories(spark, sf))


@_query
def history_rejects(spark, sf):
    docs = a.histories(spark, sf)
    return b.rejected_documents(docs).groupBy("id", "reason").agg(
        F.count(F.lit(1)).alias("documents"))


@_query
def history_json(spark, sf):
    folder = scratch_folder(spark)
    a.landed(a.histories(spark, sf)).write.text(folder)
    return b.explode_history(b.read_history(spark, folder)).select(*TICK)


@_query
def history_json_rejects(spark, sf):
    folder = scratch_folder(spark)
    a.landed(a.histories(spark, sf)).write.text(folder)
    return b.rejected_documents(b.read_history(spark, folder)).groupBy("id", "reason").agg(
        F.count(F.lit(1)).alias("documents"))


# Selection --------------------------------------------------------------------------

@_query
def top_k_series(spark, sf):
    return b.top_k(a.listing(spark, sf), b.FULL_PROFILE[0])


@_query
def top_k_ids_small_profile(spark, sf):
    return b.series_ids(b.top_k(a.listing(spark, sf), b.SMALL_PROFILE[0]))


@_query
def listing_json(spark, sf):
    folder = scratch_folder(spark)
    a.listing(spark, sf).write.json(folder)
    return b.read_listing(spark, folder)


@_query
def top_k_messy_listing(spark, sf):
    return b.top_k(a.messy_listing(spark, sf), b.FULL_PROFILE[0])


@_query
def lookback_until(spark, sf):
    # The last tick of each user is moved far into the future.
    ticks = a.ticks_by_user(spark, sf)
    late = ticks.withColumn("timestamp", F.col("timestamp") + F.lit(1000 * 86_400_000).cast("long"))
    return b.lookback(b.union_ticks([ticks, late]), b.SMALL_PROFILE[1], HALF_WAY_MS).select(*TICK)


@_query
def restrict_to_top_k(spark, sf):
    return b.restrict_to_top_k(a.ticks_by_user(spark, sf), a.listing(spark, sf)).select(*TICK)


@_query
def lookback(spark, sf):
    return b.lookback(a.ticks_by_user(spark, sf), b.SMALL_PROFILE[1]).select(*TICK)


@_query
def lookback_full_profile(spark, sf):
    return b.lookback(a.ticks_by_part(spark, sf), b.FULL_PROFILE[1]).select(*TICK)


@_query
def union_ticks(spark, sf):
    by_user = a.ticks_by_user(spark, sf).select(*TICK)
    without_caps = a.ticks_by_type(spark, sf).select("crypto_id", "volume", "price", "timestamp")
    return b.union_ticks([by_user, without_caps])


# Snapshots, tables, runs --------------------------------------------------------------

def _snapshots(spark, sf):
    """Two snapshots: the first half of the month, then all of it."""
    root = scratch_folder(spark)
    ticks = a.ticks_by_user(spark, sf)
    b.write_ticks(ticks.filter(F.col("timestamp") < HALF_WAY_MS), root, OLDER)
    b.write_ticks(ticks, root, LATEST, clustered=True)
    return root


@_query
def latest_snapshot(spark, sf):
    return b.read_ticks(spark, _snapshots(spark, sf))


@_query
def snapshot_by_date(spark, sf):
    return b.read_ticks(spark, _snapshots(spark, sf), OLDER).select(*TICK)


@_query
def snapshot_by_series(spark, sf):
    # The second write replaces only the series it holds.
    root = scratch_folder(spark)
    ticks = a.ticks_by_type(spark, sf)
    b.write_ticks(ticks, root, LATEST, by_series=True)
    again = ticks.filter("crypto_id = 'click'").withColumn("volume", F.col("volume") + 1)
    b.write_ticks(again, root, LATEST, by_series=True)
    return b.read_ticks(spark, root).select(*TICK)


def _two_way_snapshot(spark, sf):
    root = scratch_folder(spark)
    b.write_ticks(a.ticks_by_user(spark, sf), root, LATEST, clustered="both", files=16)
    return b.read_ticks(spark, root)


@_query
def lookup_by_series(spark, sf):
    return b.lookup(_two_way_snapshot(spark, sf), ["7", "11"]).select(*TICK)


@_query
def lookup_by_time(spark, sf):
    return b.lookup(_two_way_snapshot(spark, sf), None, HALF_WAY_MS, HALF_WAY_MS + 86_400_000).select(*TICK)


@_query
def latest_finished_snapshot(spark, sf):
    # The newest folder was not written to its end.
    root = scratch_folder(spark)
    ticks = a.ticks_by_user(spark, sf)
    b.write_ticks(ticks.filter(F.col("timestamp") < HALF_WAY_MS), root, OLDER)
    ticks.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{root}/ingest_date={LATEST}")
    return b.read_ticks(spark, root).select(*TICK)


@_query
def snapshot_after_failed_rerun(spark, sf):
    # Writing the date anew fails halfway, on the ticks of the second half of the month.
    root = scratch_folder(spark)
    ticks = a.ticks_by_user(spark, sf)
    b.write_ticks(ticks, root, LATEST)
    sound = F.assert_true(F.col("timestamp") < HALF_WAY_MS, F.lit("unsound")).isNull()
    try:
        b.write_ticks(ticks.withColumn("volume", F.col("volume") + 1).filter(sound), root, LATEST)
    except PySparkException as e:
        if "unsound" not in str(e):
            raise
        return b.read_ticks(spark, root, LATEST).select(*TICK)
    raise AssertionError("the second write was to fail")


@_query
def bars_after_failed_rerun(spark, sf):
    # As above, for the daily bars of a run.
    root = scratch_folder(spark)
    bars = b.clean_bars(a.ticks_by_user(spark, sf))
    b.write_bars(bars, root, LATEST)
    sound = F.assert_true(F.col("date") < F.lit(OLDER), F.lit("unsound")).isNull()
    try:
        b.write_bars(bars.withColumn("open", F.lit(0.0)).filter(sound), root, LATEST)
    except PySparkException as e:
        if "unsound" not in str(e):
            raise
        return b.read_bars(spark, root, LATEST)
    raise AssertionError("the second write was to fail")


@_query
def load_nothing(spark, sf):
    # No snapshot at all: an empty frame in the shape of the given ticks.
    ticks = a.ticks_by_user(spark, sf)
    return b.read_ticks(spark, scratch_folder(spark), on_empty="empty").select(*ticks.columns).select(*TICK)


def _legacy(spark, sf, combined: bool):
    folder = scratch_folder(spark)
    ticks = a.ticks_by_type(spark, sf).drop("datetime")
    ticks.filter("crypto_id < 'm'").write.parquet(f"{folder}/{LATEST}/low_prices.parquet")
    ticks.filter("crypto_id >= 'm'").write.parquet(f"{folder}/{LATEST}/high_prices.parquet")
    if combined:
        ticks.write.parquet(f"{folder}/{LATEST}/all_cryptos_prices.parquet")
    return b.read_legacy_ticks(spark, folder).select(*TICK)


@_query
def legacy_snapshot_combined(spark, sf):
    return _legacy(spark, sf, combined=True)


@_query
def legacy_snapshot_series_files(spark, sf):
    return _legacy(spark, sf, combined=False)


@_query
def legacy_mixed_types(spark, sf):
    # Files as their writers inferred them: whole prices as integers, an empty column
    # in another type, a column missing.
    folder = f"{scratch_folder(spark)}/{LATEST}"
    ticks = a.ticks_by_type(spark, sf).drop("datetime")
    forms = {
        "click": ticks.withColumn("price", F.col("price").cast("long")),
        "view": ticks.withColumn("volume", F.lit(None).cast("int")),
        "purchase": ticks.drop("market_cap").withColumn("timestamp", F.col("timestamp").cast("double")),
    }
    for kind, form in forms.items():
        form.filter(F.col("crypto_id") == kind).write.parquet(f"{folder}/{kind}_prices.parquet")
    ticks.filter(~F.col("crypto_id").isin(*forms)).write.parquet(f"{folder}/other_prices.parquet")
    return b.read_legacy_ticks(spark, folder.rsplit("/", 1)[0]).select(*TICK)


@_query
def validate_ticks(spark, sf):
    good, _ = b.validate_ticks(a.contract_ticks(spark, sf))
    return good.select(*TICK)


@_query
def validate_ticks_rejects(spark, sf):
    _, rejects = b.validate_ticks(a.contract_ticks(spark, sf))
    return rejects.select("crypto_id", "timestamp", "price", "reason")


def _table(spark, buckets=None, by_day=False) -> str:
    folder = scratch_folder(spark)
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    b.create_tick_table(spark, name, folder, buckets, by_day)
    return name


def _append_twice(spark, sf, on_conflict, buckets=None):
    table = _table(spark, buckets)
    b.append_ticks(a.returned_ticks_by_part(spark, sf), table, on_conflict)
    b.append_ticks(a.ticks_by_part(spark, sf), table, on_conflict)
    return spark.table(table).select(*TICK)


@_query
def append_rows(spark, sf):
    return _append_twice(spark, sf, "append")


@_query
def append_skip_existing(spark, sf):
    return _append_twice(spark, sf, "skip")


@_query
def append_skip_existing_bucketed(spark, sf):
    return _append_twice(spark, sf, "skip", buckets=8)


@_query
def append_by_day_skip_existing(spark, sf):
    # The second load overlaps the first one, and brings one tick of each user long before.
    table = _table(spark, by_day=True)
    ticks = a.ticks_by_user(spark, sf)
    b.append_ticks(ticks.filter(F.col("timestamp") < HALF_WAY_MS), table, "skip")
    first = ticks.groupBy("crypto_id").agg(F.min("timestamp").alias("timestamp"), F.min_by("price", "timestamp").alias("price"))
    old = first.withColumn("timestamp", F.col("timestamp") - F.lit(3650 * 86_400_000).cast("long")).withColumn(
        "datetime", b.utc_datetime("timestamp"))
    b.append_ticks(b.union_ticks([ticks, old]), table, "skip")
    return spark.table(table).select(*TICK)


@_query
def load_snapshot(spark, sf):
    table = _table(spark)
    b.load_snapshot(spark, _snapshots(spark, sf), table)
    return spark.table(table).select(*TICK)


@_query
def ingest_top_k(spark, sf):
    root = scratch_folder(spark)
    k, days = b.SMALL_PROFILE
    b.ingest(a.listing(spark, sf), a.histories(spark, sf), root, LATEST, k, days)
    return b.read_ticks(spark, root).select(*TICK)


@_query
def ingest_counts(spark, sf):
    root = scratch_folder(spark)
    k, days = b.SMALL_PROFILE
    c = b.ingest(a.listing(spark, sf), a.histories(spark, sf), root, LATEST, k, days).counts
    return spark.createDataFrame(
        [(c["ticks"], c["documents_rejected"], c["ticks_refused"], c["ticks_before"], c["ticks_read"])],
        "ticks bigint, documents_rejected bigint, ticks_refused bigint, ticks_before bigint, ticks_read bigint")


def _run(spark, sf, **options):
    root = scratch_folder(spark)
    raw, out = f"{root}/raw", f"{root}/processed"
    b.write_ticks(a.dirty_ticks(spark, sf), raw, LATEST)
    return out, b.run_transform(spark, raw, out, LATEST, **options)


@_query
def written_bars(spark, sf):
    out, _ = _run(spark, sf, ordered=True)
    return b.read_bars(spark, out, LATEST, METRICS)


@_query
def run_counts(spark, sf):
    _, report = _run(spark, sf)
    c = report.counts
    return spark.createDataFrame(
        [(c["raw"], c["removed"], c["clean"], c["bars"])],
        "raw bigint, removed bigint, clean bigint, bars bigint")
