from __future__ import annotations

import pytest

import barloom as b
from barloom.functions.time import MS_PER_DAY
from barloom.operators import selection
from helpers import DAY0, plan, ticks


def listing(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, market_cap double")


def test_top_k_orders_by_cap_then_id(spark):
    df = listing(spark, ("c", 5.0), ("a", 5.0), ("b", 9.0), ("z", None))
    assert [r["id"] for r in b.top_k(df, 3).collect()] == ["b", "a", "c"]
    assert [r["id"] for r in b.top_k(df, 10).collect()] == ["b", "a", "c", "z"]
    assert "TakeOrderedAndProject" in plan(b.top_k(df, 3))


def test_profiles():
    assert b.SMALL_PROFILE == (5, 7)
    assert b.FULL_PROFILE == (20, 365)


def test_restrict_to_top_k(spark):
    df = ticks(spark, [("a", 1, 1.0), ("a", 2, 1.0), ("b", 1, 1.0), (None, 1, 1.0)])
    got = b.restrict_to_top_k(df, listing(spark, ("a", 2.0), ("b", 1.0)), 1)
    assert sorted(r["timestamp"] for r in got.collect()) == [1, 2]
    assert "BroadcastHashJoin" in plan(got)


def test_repeated_id_does_not_repeat_rows(spark):
    df = ticks(spark, [("a", 1, 1.0)])
    assert b.restrict_to(df, listing(spark, ("a", 1.0), ("a", 2.0))).count() == 1


def test_long_id_list_is_not_forced_into_a_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df, ids = ticks(spark, [("a", 1, 1.0)]), listing(spark, ("a", 1.0))
        fits = selection.BROADCAST_BYTES // selection._BYTES_PER_ID
        assert "Broadcast" in plan(b.restrict_to(df, ids, at_most=fits))
        for n in (fits + 1, None):
            got = b.restrict_to(df, ids, at_most=n)
            assert "Broadcast" not in plan(got)
            assert got.count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookback(spark):
    last = DAY0 + 10 * MS_PER_DAY
    df = ticks(spark, [("a", last, 1.0), ("b", last - 7 * MS_PER_DAY, 1.0),
                       ("b", last - 7 * MS_PER_DAY + 1, 1.0)])

    def times(frame):
        return sorted(r["timestamp"] - last for r in frame.collect())

    assert times(b.lookback(df, 7)) == [-7 * MS_PER_DAY + 1, 0]
    assert times(b.lookback(df, 8, until_ms=last - 1)) == [-7 * MS_PER_DAY, -7 * MS_PER_DAY + 1]


def test_lookback_reaches_the_scan(spark, tmp_path):
    b.write_ticks(ticks(spark, [("a", DAY0, 1.0)]), str(tmp_path), "2024-01-01")
    text = plan(b.lookback(b.read_ticks(spark, str(tmp_path)), 7, until_ms=DAY0 + 5))
    assert "GreaterThan(timestamp," in text and "LessThanOrEqual(timestamp," in text


def test_union_goes_by_name_and_keeps_copies(spark):
    one = spark.createDataFrame([("a", 1)], "crypto_id string, timestamp bigint")
    two = spark.createDataFrame([(1, 2.0, "a")], "timestamp bigint, price double, crypto_id string")
    got = b.union_ticks([one, one, two])
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 1, 2.0), ("a", 1, None), ("a", 1, None)]
    with pytest.raises(ValueError):
        b.union_ticks([])
