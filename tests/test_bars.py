from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import barloom as b
from barloom.functions.time import MS_PER_DAY, epoch_ms, utc_datetime, utc_day
from barloom.operators.bars import merge_bars, partial_bars
from barloom.operators.cleaning import crowded
from barloom.plans.transform import LAYOUTS, by_slice
from barloom.schema import BARS
from helpers import DAY0, by_day, count_nodes, model_metrics, plan, ticks

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_one_day(spark):
    df = ticks(spark, [("a", DAY0 + 2, 7.0, 1.0, 10.0), ("a", DAY0, 5.0, None, 11.0),
                       ("a", DAY0 + 3, 6.0, 2.0, None), ("a", DAY0 + 1, 4.0, 3.0, 10.0)])
    bars = b.daily_bars(df)
    assert by_day(bars, *BARS.names) == [("a", D1, 5.0, 7.0, 4.0, 6.0, 6.0, 10.0, 4)]
    assert bars.dtypes == [(f.name, f.dataType.simpleString()) for f in BARS.fields]


def test_day_without_volume_or_cap(spark):
    assert by_day(b.daily_bars(ticks(spark, [("a", DAY0, 5.0)])), "volume", "market_cap") == [
        (None, None)]


def test_market_cap_rounds_half_up(spark):
    df = ticks(spark, [("a", DAY0, 5.0, 1.0, 2.0), ("a", DAY0 + 1, 5.0, 1.0, 3.0)])
    assert by_day(b.daily_bars(df), "market_cap") == [(3.0,)]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_days_are_utc_days_in_every_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        last, first = DAY0 + MS_PER_DAY - 1, DAY0 + MS_PER_DAY
        df = ticks(spark, [("a", DAY0, 1.0), ("a", last, 2.0), ("a", first, 3.0)])
        assert by_day(b.daily_bars(df), "date", "open", "close") == [(D1, 1.0, 2.0), (D2, 3.0, 3.0)]
        # 02:30 on that day does not exist in New York.
        gap = dt.datetime(2024, 3, 10, 2, 30, 0, 123000)
        ms = int((gap - dt.datetime(1970, 1, 1)) / dt.timedelta(milliseconds=1))
        row = spark.createDataFrame([(ms, -1)], "ms bigint, early bigint").select(
            utc_datetime("ms").alias("at"), utc_day("ms").alias("day"),
            epoch_ms(utc_datetime("ms")).alias("back"), utc_day("early").alias("early"),
            epoch_ms(utc_datetime("early")).alias("early_back")).first()
        assert tuple(row) == (gap, gap.date(), ms, dt.date(1969, 12, 31), -1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_with_calendar(spark):
    row = b.with_calendar(ticks(spark, [("a", DAY0 + 1500, 1.0)]).drop("datetime")).first()
    assert (row["datetime"], row["date"]) == (dt.datetime(2024, 1, 1, 0, 0, 1, 500000), D1)


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(1500):
        cid = rng.choice(["hot"] * 6 + ["a", "b", "c", None])
        ts = DAY0 + rng.randrange(0, 60) * MS_PER_DAY + rng.choice([0, 1, 2, MS_PER_DAY - 1])
        price = rng.choice([None, float("nan"), -1.0, 0.0] + [float(rng.randrange(1, 90000))] * 30)
        rows.append((cid, ts if rng.random() > 0.02 else None, price,
                     rng.choice([None, float(rng.randrange(100))]),
                     rng.choice([None, float(rng.randrange(100))])))
    return rows


@pytest.mark.parametrize("calendar", [False, True])
@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("seed", [1, 2])
def test_metrics_equal_the_row_by_row_model(spark, seed, layout, calendar):
    rows = random_rows(seed)
    df = b.daily_metrics(ticks(spark, rows).repartition(5), layout, calendar)
    assert [tuple(r) for r in df.orderBy("crypto_id", "date").collect()] == model_metrics(
        rows, calendar)


def test_invariants(spark):
    df = ticks(spark, random_rows(3))
    bars = b.clean_bars(df)
    assert bars.filter("NOT (low <= open AND open <= high AND low <= close AND close <= high)").count() == 0
    assert b.bar_counts(bars).first()["ticks"] == b.clean_ticks(df).count()


def test_densest_bar(spark):
    df = ticks(spark, [("a", DAY0, 1.0)] * 3 + [("a", DAY0 + MS_PER_DAY, 1.0)])
    assert b.densest_bar(df).first()["rows"] == 3
    with pytest.raises(ValueError):
        b.clean_bars(df, "unique")


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(5)
    rows = [("a", DAY0 + i, 1.0, rng.random() * 10 ** rng.randrange(6), rng.random() * 1e9) for i in range(3000)]
    seen = set()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for parts in (3, 7, 16):
            rng.shuffle(rows)
            for layout in LAYOUTS:
                got = b.clean_bars(ticks(spark, rows).repartition(parts), layout).first()
                seen.add((got["volume"], got["market_cap"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(seen) == 1


@pytest.mark.parametrize(("layout", "shuffles"), [("spread", 3), ("sliced", 2), ("by_bar", 2)])
def test_shuffles_of_a_run(spark, tmp_path, layout, shuffles):
    b.write_ticks(ticks(spark, [("a", DAY0 + i, 5.0) for i in range(3000)]), str(tmp_path), "2024-01-01")
    for calendar in (False, True):
        df = b.daily_metrics(b.read_ticks(spark, str(tmp_path)), layout, calendar)
        text = plan(df)
        assert count_nodes(df, "Exchange") == shuffles, text
        assert "rangepartitioning" not in text and "Python" not in text
        assert "datetime" not in text[text.index("ReadSchema"):]
        assert "GreaterThan(price,0.0)" in text


def test_sliced_sorts_ticks_once_and_merges_states_in_place(spark, tmp_path):
    b.write_ticks(ticks(spark, [("a", DAY0 + i, 5.0) for i in range(3000)]), str(tmp_path), "2024-01-01")
    df = b.daily_metrics(b.read_ticks(spark, str(tmp_path)), "sliced")
    text = plan(df)
    shuffles = [x for x in text.splitlines() if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 2 and "hashpartitioning(crypto_id" in shuffles[0] and "slice" not in shuffles[0], text
    assert "slice" in shuffles[1]
    # Nothing is sorted before the ticks' shuffle.
    assert "Sort" not in text[text.index(shuffles[1]):]


def test_copies_of_a_tick_are_reduced_before_the_shuffle(spark):
    # A third of the rows are copies of one tick, a third are one series.
    n = 6000
    rows = [("copied", DAY0, float(i % 5 + 1), 1.0, 2.0) for i in range(n)]
    rows += [("long", DAY0 + i * 60_000, 1.0 + i % 7, 1.0, 2.0) for i in range(n)]
    rows += [(f"s{i % 100}", DAY0 + i * 1000, 2.0, None, 3.0) for i in range(n)] + [(None, DAY0, 1.0, None, None)] * n
    df = ticks(spark, rows).repartition(6)
    assert 1 <= len(crowded(df)) < 256 and crowded(df.filter("crypto_id <> 'copied'")) == []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    placed = by_slice(df).groupBy(F.spark_partition_id().alias("p")).count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in placed) < n / 2 and sum(r["count"] for r in placed) < 2 * n + 10
    got = b.daily_metrics(df, "sliced").orderBy("crypto_id", "date").collect()
    assert [tuple(r) for r in got] == model_metrics(rows)
    assert b.clean_bars(df.filter("crypto_id = 'copied'"), "sliced").first()["high"] == 5.0
    assert b.clean_bars(df.limit(0), "sliced").count() == 0


def test_states_of_a_day_merge_in_any_cut(spark):
    rng = random.Random(8)
    rows = [("a", DAY0 + rng.randrange(3 * MS_PER_DAY), rng.random(), rng.choice([None, rng.random()]), rng.choice([None, 1.5]))
            for _ in range(500)]
    df = b.clean_ticks(ticks(spark, rows))
    want = rows_of(b.daily_bars(df))
    for slices in (F.lit(0), F.col("timestamp"), F.col("timestamp") % 7):
        # Slices need not be times, but lie in one day each.
        cut = df.withColumn("slice", F.struct(F.floor(F.col("timestamp") / MS_PER_DAY), slices))
        assert rows_of(merge_bars(partial_bars(cut))) == want


def rows_of(bars):
    return sorted(tuple(r) for r in bars.collect())


def test_partial_bars_leave_a_task_as_one_row_per_day(spark):
    # One series and day, many ticks and tasks: what is shuffled is one partial bar a task.
    df = b.clean_bars(ticks(spark, [("hot", DAY0 + i, 1.0) for i in range(5000)]))
    text = plan(df)
    assert text.index("partial_min_by") > text.index("Exchange hashpartitioning(crypto_id")
    assert by_day(df, "data_points") == [(5000,)]
