from __future__ import annotations

import pytest

import barloom as b
from barloom.plans.transform import clean_bars
from helpers import by_day, closes, count_nodes, half_up, plan


def test_single_bar(spark):
    m = b.add_metrics(closes(spark, [5.0]))
    assert by_day(m, "ma_7d", "ma_30d", "change_1d_pct", "change_7d_pct", "volatility_7d") == [
        (5.0, 5.0, None, None, None)]


def test_seventh_and_eighth_bar(spark):
    m = b.add_metrics(closes(spark, [float(i) for i in range(1, 10)]))
    got = by_day(m, "ma_7d", "change_7d_pct", "volatility_7d")
    assert got[6] == (4.0, None, 2.16)
    assert got[7] == (5.0, 700.0, 2.16)
    assert got[8] == (6.0, 350.0, 2.16)


def test_thirty_bars_fill_the_long_average(spark):
    values = [float(i * i) for i in range(1, 33)]
    got = [v for v, in by_day(b.moving_averages(closes(spark, values)), "ma_30d")]
    for i, v in enumerate(got):
        window = values[max(0, i - 29): i + 1]
        assert v == half_up(sum(window) / len(window), 2)


def test_rounds_half_up(spark):
    assert by_day(b.moving_averages(closes(spark, [1.0, 1.25])), "ma_7d")[1] == (1.13,)


def test_zero_close_gives_null_change(spark):
    m = b.price_changes(closes(spark, [0.0, 5.0, 10.0]))
    assert by_day(m, "change_1d_pct") == [(None,), (None,), (100.0,)]
    assert m.columns == ["crypto_id", "date", "close", "change_1d_pct", "change_7d_pct"]


def test_gaps_count_as_days_on_request_only(spark):
    bars = closes(spark, [1.0, 2.0, 4.0, 8.0], days=[0, 1, 7, 14])
    rows = by_day(b.lagged_closes(bars), "prev_close", "close_7d_ago")
    days = by_day(b.lagged_closes(bars, calendar=True), "prev_close", "close_7d_ago")
    assert rows == [(None, None), (1.0, None), (2.0, None), (4.0, None)]
    assert days == [(None, None), (1.0, None), (None, 1.0), (None, 4.0)]
    assert by_day(b.moving_averages(bars), "ma_7d")[3] == (3.75,)
    assert by_day(b.moving_averages(bars, calendar=True), "ma_7d") == [(1.0,), (1.5,), (3.0,), (8.0,)]
    assert by_day(b.volatility(bars, calendar=True), "volatility_7d")[3] == (None,)


def test_series_do_not_mix(spark):
    bars = closes(spark, [1.0, 2.0], "a").union(closes(spark, [10.0, 30.0], "b"))
    assert by_day(b.price_changes(bars), "crypto_id", "change_1d_pct") == [
        ("a", None), ("a", 100.0), ("b", None), ("b", 200.0)]


def test_constant_close_has_no_spread(spark):
    assert by_day(b.volatility(closes(spark, [0.1] * 9)), "volatility_7d")[8] == (0.0,)


def test_all_metrics_equal_the_single_ones(spark):
    bars = closes(spark, [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0], days=[0, 1, 2, 4, 5, 6, 9, 13])
    for calendar in (False, True):
        chained = b.volatility(b.price_changes(b.moving_averages(bars, calendar), calendar), calendar)
        together = b.add_metrics(bars, calendar)
        assert together.columns == chained.columns
        assert by_day(together, *together.columns) == by_day(chained, *chained.columns)


def test_one_window_one_shuffle(spark):
    for calendar in (False, True):
        m = b.add_metrics(closes(spark, [1.0, 2.0]), calendar)
        assert count_nodes(m, "Window") == 1
        assert count_nodes(m, "Exchange") == 1
        assert count_nodes(m, "Sort") == 1
        assert "Python" not in plan(m)


@pytest.mark.parametrize("layout", ["sliced", "by_bar"])
def test_small_partitions_of_ticks_are_not_put_together(spark, layout):
    # Adaptive execution would make one task of these few bytes, and of as many again on large tables.
    ticks = spark.range(4000).selectExpr(
        "id * 3600000 AS timestamp", "string(id % 50) AS crypto_id", "double(id % 7 + 1) AS price",
        "1D AS volume", "2D AS market_cap")
    bars = clean_bars(ticks, layout)
    assert bars.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
