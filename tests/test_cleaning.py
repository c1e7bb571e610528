from __future__ import annotations

import barloom as b
from helpers import DAY0, count_nodes, plan, ticks

NAN = float("nan")


def values(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_drop_incomplete_takes_null_and_nan(spark):
    df = ticks(spark, [("a", 1, 5.0), (None, 1, 5.0), ("a", None, 5.0), ("a", 2, None),
                       ("a", 3, NAN), ("a", 4, -1.0)])
    assert values(b.drop_incomplete(df), "timestamp") == [(1,), (4,)]


def test_missing_volume_is_no_defect(spark):
    assert b.drop_incomplete(ticks(spark, [("a", 1, 5.0, None, None)])).count() == 1


def test_positive_price_is_strict(spark):
    df = ticks(spark, [("a", 1, 0.0), ("a", 2, -1.0), ("a", 3, 1e-9), ("a", 4, None)])
    assert values(b.positive_price(df), "timestamp") == [(3,)]


def test_dedup_keeps_highest_price_then_volume_then_cap(spark):
    df = ticks(spark, [
        ("a", 1, 5.0, 9.0, 9.0), ("a", 1, 6.0, 1.0, 1.0),
        ("a", 2, 5.0, None, 9.0), ("a", 2, 5.0, 1.0, 1.0),
        ("a", 3, 5.0, 1.0, None), ("a", 3, 5.0, 1.0, 2.0),
        ("b", 1, 4.0, 1.0, 1.0), ("b", 1, 4.0, 1.0, 1.0)])
    assert values(b.dedup_ticks(df), "crypto_id", "timestamp", "price", "volume", "market_cap") == [
        ("a", 1, 6.0, 1.0, 1.0), ("a", 2, 5.0, 1.0, 1.0), ("a", 3, 5.0, 1.0, 2.0),
        ("b", 1, 4.0, 1.0, 1.0)]


def test_dedup_takes_null_keys_as_keys(spark):
    df = ticks(spark, [(None, 1, 5.0), (None, 1, 6.0), ("a", None, 1.0), ("a", None, 2.0)])
    assert values(b.dedup_ticks(df), "price") == [(2.0,), (6.0,)]


def test_dedup_does_not_depend_on_order_or_partitions(spark):
    rows = [("a", i % 7, float(i % 5 + 1), float(i % 3), None) for i in range(200)]
    want = values(b.dedup_ticks(ticks(spark, rows)), "timestamp", "price", "volume")
    for n in (1, 3, 16):
        got = b.dedup_ticks(ticks(spark, rows[::-1]).repartition(n))
        assert values(got, "timestamp", "price", "volume") == want


def test_invalid_copy_does_not_hide_a_valid_one(spark):
    df = ticks(spark, [("a", 1, -1.0), ("a", 1, 5.0), ("a", 1, NAN)])
    assert values(b.clean_ticks(df), "price") == [(5.0,)]


def test_clean_keeps_schema(spark):
    df = ticks(spark, [("a", 1, 5.0)])
    assert b.clean_ticks(df).columns == df.columns


def test_report_adds_up(spark):
    df = ticks(spark, [("a", 1, 5.0), ("a", 1, 6.0), ("a", 1, -1.0), ("a", 2, 0.0), (None, 2, 1.0),
                       (None, 2, 1.0), ("a", 3, NAN), ("b", 1, 1.0), ("a", DAY0 * 1_000_000, 1.0)])
    r = b.cleaning_report(df).first().asDict()
    assert r == {"initial_rows": 9, "incomplete_rows": 3, "out_of_range_rows": 1, "non_positive_rows": 2,
                 "duplicate_rows": 1, "final_rows": 2, "removed_rows": 7}
    assert r["final_rows"] == b.clean_ticks(df).count()


def test_report_of_nothing_is_zeros(spark):
    assert set(b.cleaning_report(ticks(spark, [])).first()) == {0}


def test_copies_are_reduced_before_the_shuffle(spark):
    # A third and more of the rows are copies of one key, spread over 8 tasks.
    rows = [("hot", 1, 5.0, 1.0, 1.0)] * 4000 + [("a", i, 1.0, 1.0, 1.0) for i in range(400)]
    df = b.dedup_ticks(ticks(spark, rows).repartition(8))
    text = plan(df)
    exchange = text.index("Exchange hashpartitioning(timestamp")
    assert "Partial" in text[exchange:], text
    assert df.count() == 401


def test_row_rules_reach_the_scan(spark, tmp_path):
    path, _ = b.write_ticks(ticks(spark, [("a", DAY0, 5.0)]), str(tmp_path), "2024-01-01")
    text = plan(b.clean_ticks(b.read_ticks(spark, str(tmp_path))))
    pushed = text[text.index("PushedFilters"):]
    for part in ("IsNotNull(crypto_id)", "IsNotNull(timestamp)", "GreaterThan(price,0.0)"):
        assert part in pushed
    assert count_nodes(b.clean_ticks(b.read_ticks(spark, str(tmp_path))), "Exchange") == 1
