from __future__ import annotations

import datetime as dt
import json
import uuid

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import barloom as b
from barloom.__main__ import main
from barloom.functions.time import MS_PER_DAY
from barloom.plans.ingest import end_of, judged_ticks
from barloom.schema import METRICS, TICKS, conform
from barloom.sinks.tables import by_bucket
from helpers import DAY0, count_nodes, model_metrics, plan, scan_rows, ticks


def rows(df, *names):
    names = names or ("crypto_id", "timestamp", "price")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def table_name():
    return "t_" + uuid.uuid4().hex


# Snapshots ----------------------------------------------------------------------------

def test_latest_and_dated_snapshot(spark, tmp_path):
    root = str(tmp_path)
    path, n = b.write_ticks(ticks(spark, [("a", 1, 1.0)]), root, "2024-01-01")
    assert (path, n) == (f"{root}/ingest_date=2024-01-01", 1)
    b.write_ticks(ticks(spark, [("a", 1, 2.0), ("b", 1, 3.0)]), root, "2024-01-10")
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "zzz").mkdir()
    assert b.snapshot_dates(spark, root) == ["2024-01-01", "2024-01-10"]
    assert rows(b.read_ticks(spark, root)) == [("a", 1, 2.0), ("b", 1, 3.0)]
    assert rows(b.read_ticks(spark, root, "2024-01-01")) == [("a", 1, 1.0)]
    assert b.read_ticks(spark, root).schema == TICKS


def test_snapshot_is_replaced(spark, tmp_path):
    root = str(tmp_path)
    b.write_ticks(ticks(spark, [("a", 1, 1.0), ("b", 1, 1.0)]), root, "2024-01-01")
    b.write_ticks(ticks(spark, [("a", 1, 2.0)]), root, "2024-01-01")
    assert rows(b.read_ticks(spark, root)) == [("a", 1, 2.0)]


def test_by_series_replaces_only_its_series(spark, tmp_path):
    root = str(tmp_path)
    b.write_ticks(ticks(spark, [("007", 1, 1.0), ("b/c", 1, 1.0)]), root, "2024-01-01", by_series=True)
    b.write_ticks(ticks(spark, [("007", 2, 2.0)]), root, "2024-01-01", by_series=True)
    got = b.read_ticks(spark, root)
    assert rows(got) == [("007", 2, 2.0), ("b/c", 1, 1.0)]
    assert got.schema == TICKS


def test_clustered_files_are_sorted(spark, tmp_path):
    data = [(c, t, 1.0) for t in range(50) for c in "cab"]
    path, n = b.write_ticks(ticks(spark, data).repartition(4), str(tmp_path), "2024-01-01", clustered=True)
    assert n == 150
    spans = []
    for f in sorted((tmp_path / "ingest_date=2024-01-01").glob("*.parquet")):
        t = pq.read_table(f, columns=["crypto_id", "timestamp"], partitioning=None).to_pylist()
        keys = [(r["crypto_id"], r["timestamp"]) for r in t]
        assert keys == sorted(keys)
        spans.append((keys[0], keys[-1]))
    spans.sort()
    assert all(a[1] < z[0] for a, z in zip(spans, spans[1:]))
    assert rows(b.read_ticks(spark, str(tmp_path))) == sorted(data)
    with pytest.raises(ValueError):
        b.write_ticks(ticks(spark, data), str(tmp_path), "x", by_series=True, clustered=True)


@pytest.mark.parametrize("read", [b.read_ticks, b.read_legacy_ticks])
def test_no_snapshot(spark, tmp_path, read):
    for root in (str(tmp_path), str(tmp_path / "absent")):
        for date in (None, "2024-01-01"):
            with pytest.raises(FileNotFoundError):
                read(spark, root, date)
            empty = read(spark, root, date, on_empty="empty")
            assert empty.count() == 0 and empty.columns == TICKS.names
    with pytest.raises(ValueError):
        read(spark, str(tmp_path), on_empty="zero")


def legacy_file(folder, name, data):
    """As older jobs wrote them: pandas, wall clock in nanoseconds."""
    folder.mkdir(parents=True, exist_ok=True)
    frame = pd.DataFrame(data, columns=["crypto_id", "timestamp", "price"])
    frame["datetime"] = pd.to_datetime(frame["timestamp"] + 3_600_000, unit="ms").astype("datetime64[ns]")
    frame["volume"], frame["market_cap"] = 1.0, None
    frame["market_cap"] = frame["market_cap"].astype("float64")
    pq.write_table(pa.Table.from_pandas(frame, preserve_index=False), folder / name, version="2.6")


def test_legacy_layout(spark, tmp_path):
    legacy_file(tmp_path / "2023-12-31", "all_cryptos_prices.parquet", [("old", 1, 1.0)])
    legacy_file(tmp_path / "2024-01-01", "a_prices.parquet", [("a", DAY0, 1.0)])
    legacy_file(tmp_path / "2024-01-01", "b_prices.parquet", [("b", DAY0, 2.0)])
    (tmp_path / "archive").mkdir()
    got = b.read_legacy_ticks(spark, str(tmp_path))
    assert rows(got) == [("a", DAY0, 1.0), ("b", DAY0, 2.0)]
    assert got.first()["datetime"] == dt.datetime(2024, 1, 1)
    assert rows(got, "market_cap") == [(None,), (None,)]
    legacy_file(tmp_path / "2024-01-01", "all_cryptos_prices.parquet", [("a", DAY0, 1.0), ("b", DAY0, 2.0)])
    assert b.read_legacy_ticks(spark, str(tmp_path)).count() == 2
    assert rows(b.read_legacy_ticks(spark, str(tmp_path), "2023-12-31")) == [("old", 1, 1.0)]


def test_conform(spark):
    df = ticks(spark, [("a", 1, 1.0)])
    as_float = df.selectExpr("cast(price AS float) AS price", "* EXCEPT (price)", "1 AS extra")
    assert conform(as_float, TICKS).schema == TICKS
    with pytest.raises(ValueError, match="volume"):
        conform(df.drop("volume"), TICKS)


def test_snapshot_serves_lookups_by_series_and_by_time(spark, tmp_path):
    hour = 3_600_000
    data = [(f"s{i % 40:02}", DAY0 + (i // 40) * hour, float(i)) for i in range(40 * 250)]
    data += [("s07", DAY0, 1.0)] * 500
    df = ticks(spark, data).repartition(4)
    read = {}
    for way in (True, "both"):
        root = str(tmp_path / str(way))
        assert b.write_ticks(df, root, "2024-01-01", clustered=way, files=25)[1] == len(data)
        got = b.read_ticks(spark, root)
        assert rows(got) == sorted(data)
        by_series, by_time = b.lookup(got, ["s11"]), b.lookup(got, None, DAY0 + 100 * hour, DAY0 + 109 * hour)
        assert rows(by_series) == sorted(r for r in data if r[0] == "s11")
        assert by_time.count() == 400
        read[way] = (scan_rows(by_series, "crypto_id"), scan_rows(by_time, "crypto_id"))
    # Sorted by series only, a lookup by time opens about all; two ways, a fraction for both.
    assert read[True][1] > 0.9 * len(data)
    assert max(read["both"]) < 0.45 * len(data)
    assert rows(b.lookup(got, ["s11", "s12"], DAY0, DAY0 + hour)) == sorted(
        r for r in data if r[0] in ("s11", "s12") and r[1] <= DAY0 + hour)
    assert b.write_ticks(ticks(spark, []), str(tmp_path / "none"), "2024-01-01", clustered="both")[1] == 0
    with pytest.raises(ValueError):
        b.write_ticks(df, root, "2024-01-01", clustered="x")


def failing(df, column="price", least=3.0):
    """The same rows, until one with a value of `least` or more is met."""
    return df.filter(F.assert_true(F.col(column) < least, F.lit("unsound")).isNull())


@pytest.mark.parametrize("options", [{}, {"by_series": True}, {"clustered": True}])
def test_failed_rerun_leaves_the_snapshot(spark, tmp_path, options):
    root = str(tmp_path / "raw")
    old = [("a", 1, 1.0), ("b", 1, 2.0)]
    b.write_ticks(ticks(spark, old), root, "2024-01-01", **options)
    again = ticks(spark, [("a", 1, 2.0), ("b", 2, 2.5), ("c", 1, 3.0)]).repartition(3)
    with pytest.raises(PySparkException, match="unsound"):
        b.write_ticks(failing(again), root, "2024-01-01", **options)
    for date in (None, "2024-01-01"):
        assert rows(b.read_ticks(spark, root, date)) == old
    b.write_ticks(again, root, "2024-01-01", **options)
    assert rows(b.read_ticks(spark, root)) == [("a", 1, 2.0), ("b", 2, 2.5), ("c", 1, 3.0)]


@pytest.mark.parametrize("ordered", [False, True])
def test_failed_rerun_leaves_the_bars(spark, tmp_path, ordered):
    root = str(tmp_path / "out")
    bars = b.daily_bars(ticks(spark, [("b", DAY0, 1.0), ("a", DAY0, 2.0)]))
    b.write_bars(bars, root, "2024-01-01", ordered)
    with pytest.raises(PySparkException, match="unsound"):
        b.write_bars(failing(b.daily_bars(ticks(spark, [("a", DAY0, 9.0)])), "close"), root, "2024-01-01", ordered)
    got = b.read_bars(spark, root, "2024-01-01")
    assert rows(got, "crypto_id", "close") == [("a", 2.0), ("b", 1.0)]
    assert b.write_bars(bars.filter("close > 5"), root, "2024-01-01", ordered)[1:] == (0, 0)
    assert b.read_bars(spark, root, "2024-01-01").count() == 0


def test_snapshot_without_rows_replaces_one_with_rows(spark, tmp_path):
    root = str(tmp_path / "raw")
    b.write_ticks(ticks(spark, [("a", 1, 1.0)]), root, "2024-01-01")
    assert b.write_ticks(ticks(spark, []), root, "2024-01-01")[1] == 0
    assert b.read_ticks(spark, root, "2024-01-01").count() == 0 and b.snapshot_dates(spark, root) == ["2024-01-01"]


def test_commit_cut_off_between_series_is_seen(spark, tmp_path):
    root, part = str(tmp_path / "raw"), tmp_path / "raw" / "ingest_date=2024-01-02"
    b.write_ticks(ticks(spark, [("a", 1, 0.5)]), root, "2024-01-01")
    data = [("a", 1, 1.0), ("b", 1, 2.0)]
    b.write_ticks(ticks(spark, data), root, "2024-01-02", by_series=True)
    assert rows(b.read_ticks(spark, root)) == data
    (part / "crypto_id=b").rename(tmp_path / "moved")  # as if it had not been put in place yet
    assert b.snapshot_dates(spark, root) == ["2024-01-01"] and rows(b.read_ticks(spark, root)) == [("a", 1, 0.5)]
    with pytest.raises(ValueError, match="not finished"):
        b.read_ticks(spark, root, "2024-01-02")
    (tmp_path / "moved").rename(part / "crypto_id=b")
    assert rows(b.read_ticks(spark, root)) == data
    # A series that is another write's file under the same name of folder.
    file = next((part / "crypto_id=b").glob("*.parquet"))
    file.rename(file.with_name("part-other.snappy.parquet"))
    assert b.snapshot_dates(spark, root) == ["2024-01-01"]
    b.write_ticks(ticks(spark, data), root, "2024-01-02", by_series=True)
    assert b.snapshot_dates(spark, root) == ["2024-01-01", "2024-01-02"]


def test_snapshot_of_another_program_needs_its_own_mark(spark, tmp_path):
    root = str(tmp_path / "raw")
    ticks(spark, [("a", 1, 1.0)]).write.parquet(f"{root}/ingest_date=2024-01-01")
    assert rows(b.read_ticks(spark, root)) == [("a", 1, 1.0)]
    (tmp_path / "raw" / "ingest_date=2024-01-01" / "_SUCCESS").unlink()
    assert b.snapshot_dates(spark, root) == []


def pandas_file(path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pd.DataFrame(columns).to_parquet(path, index=False)


def test_older_files_are_read_by_their_own_types(spark, tmp_path):
    day = tmp_path / "2024-01-01"
    stamp = pd.to_datetime([DAY0, DAY0 + 1], unit="ms").astype("datetime64[ns]")
    both = [DAY0, DAY0 + 1]
    pandas_file(day / "a_prices.parquet", timestamp=both, datetime=stamp, crypto_id=["a"] * 2, price=[1.5, 2.5],
                volume=[1.0, None], market_cap=[10.0, 20.0])
    pandas_file(day / "b_prices.parquet", timestamp=both, datetime=stamp, crypto_id=["b"] * 2, price=[3, 4],
                volume=[None, None], market_cap=[7, 8])
    pandas_file(day / "c_prices.parquet", timestamp=[float(DAY0), None], crypto_id=["c"] * 2, price=[5.0, float("nan")])
    pandas_file(day / "d_prices.parquet", timestamp=[10**18, DAY0], crypto_id=[7, 8], price=[6.0, 7.0], volume=["x", "2"], extra=[1, 2])
    got = b.read_legacy_ticks(spark, str(tmp_path))
    assert got.schema == TICKS
    assert sorted(map(str, (tuple(r) for r in got.select("crypto_id", "timestamp", "price", "volume", "market_cap").collect()))) == sorted(map(str, [
        ("a", DAY0, 1.5, 1.0, 10.0), ("a", DAY0 + 1, 2.5, None, 20.0), ("b", DAY0, 3.0, None, 7.0), ("b", DAY0 + 1, 4.0, None, 8.0),
        ("c", DAY0, 5.0, None, None), ("c", None, None, None, None), ("7", 10**18, 6.0, None, None), ("8", DAY0, 7.0, 2.0, None)]))
    assert rows(got.filter("datetime IS NULL"), "crypto_id") == [("7",), ("c",)]
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") == "false"
    files = [line for line in plan(got).splitlines() if "FileScan" in line]
    assert len(files) == 4  # one scan a schema, not one a file
    pandas_file(day / "e_prices.parquet", timestamp=both, crypto_id=["e"] * 2, price=[9, 9], volume=[None, None], market_cap=[7, 8])
    assert len([x for x in plan(b.read_legacy_ticks(spark, str(tmp_path))).splitlines() if "FileScan" in x]) == 4


# The tick table -----------------------------------------------------------------------

def test_contract(spark):
    ok = [("a", 1, 1.0), ("x" * 50, 1, None)]
    df = ticks(spark, ok + [(None, 1, 1.0), ("a", None, 1.0), ("x" * 51, 1, 1.0)])
    good, rejects = b.validate_ticks(df)
    assert good.count() == 2
    assert rows(rejects, "reason") == [("crypto_id is null",), ("crypto_id is too long",),
                                       ("timestamp is null",)]


@pytest.mark.parametrize("buckets", [None, 4])
def test_append(spark, tmp_path, buckets):
    name = table_name()
    b.create_tick_table(spark, name, str(tmp_path / "t"), buckets)
    b.create_tick_table(spark, name, str(tmp_path / "t"), buckets)
    first = ticks(spark, [("a", 1, 1.0), ("a", 1, 2.0), ("b", 1, None)])
    assert b.append_ticks(first, name) == 3
    assert b.append_ticks(first, name) == 3
    assert spark.table(name).count() == 6
    assert spark.table(name).filter("created_at IS NULL").count() == 0


@pytest.mark.parametrize("buckets", [None, 4])
def test_skip_existing_can_be_repeated(spark, tmp_path, buckets):
    name = table_name()
    b.create_tick_table(spark, name, str(tmp_path / "t"), buckets)
    first = ticks(spark, [("a", 1, 1.0), ("a", 1, 2.0), ("b", 1, 5.0)])
    second = ticks(spark, [("a", 1, 9.0), ("b", 2, 1.0), ("b", 1, 7.0), ("c", 0, 1.0)])
    assert b.append_ticks(first, name, "skip") == 2
    assert b.append_ticks(second, name, "skip") == 2
    assert b.append_ticks(second, name, "skip") == 0
    assert rows(spark.table(name)) == [("a", 1, 2.0), ("b", 1, 5.0), ("b", 2, 1.0), ("c", 0, 1.0)]
    with pytest.raises(ValueError):
        b.append_ticks(second, name, "replace")


def test_load_by_day_opens_the_days_of_the_batch(spark, tmp_path):
    days, old = 40, DAY0 - 9000 * MS_PER_DAY
    data = [("s", DAY0 + d * MS_PER_DAY + i, float(i + 1)) for d in range(days) for i in range(25)]
    batch = ticks(spark, [("s", DAY0 + 3 * MS_PER_DAY, 9.0), ("s", DAY0 + 30 * MS_PER_DAY + 777, 1.0), ("s", old, 1.0)])
    read = {}
    for by_day in (True, False):
        name = table_name()
        b.create_tick_table(spark, name, str(tmp_path / name), by_day=by_day)
        assert b.append_ticks(ticks(spark, data), name) == len(data)
        read[by_day] = scan_rows(b.without_existing(batch, spark.table(name)), "crypto_id")
        assert b.append_ticks(batch, name, "skip") == 2
        assert b.append_ticks(batch, name, "skip") == 0
        assert spark.table(name).count() == len(data) + 2
    assert read[True] == 2 * 25  # of the plain table, one old tick opens all up to the last one
    assert read[False] > 15 * read[True]
    with pytest.raises(ValueError):
        b.create_tick_table(spark, table_name(), buckets=4, by_day=True)


def test_breach_of_contract_fails_the_load(spark, tmp_path):
    name = table_name()
    b.create_tick_table(spark, name, str(tmp_path / "t"))
    for bad in ((None, 1, 1.0), ("a", None, 1.0), ("x" * 51, 1, 1.0)):
        with pytest.raises(PySparkException):
            b.append_ticks(ticks(spark, [("a", 1, 1.0), bad]), name)
    assert spark.table(name).count() == 0


def test_skip_existing_plan(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for buckets, exchanges in ((None, 2), (16, 2)):  # with buckets both are the batch's
            name = table_name()
            b.create_tick_table(spark, name, str(tmp_path / name), buckets)
            batch = ticks(spark, [("a", 1, 2.0), ("b", 2, 1.0)]).repartition(3)
            b.append_ticks(ticks(spark, [("a", 1, 1.0)]), name)
            text = plan(b.without_existing(batch, spark.table(name), buckets))
            assert text.count("Exchange hashpartitioning(timestamp") == exchanges, text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_copies_of_a_tick_are_dealt_to_several_files_of_a_bucket(spark, tmp_path):
    n = 3000
    data = [("copied", DAY0, 1.0)] * n + [(f"s{i % 50}", DAY0 + i, 2.0) for i in range(2 * n)]
    df = ticks(spark, data).repartition(5)
    sizes = {r["p"]: r["count"] for r in by_bucket(df, 8, df).groupBy(F.spark_partition_id().alias("p")).count().collect()}
    assert len(sizes) == 8 and max(sizes.values()) < n / 2 and sum(sizes.values()) == 3 * n
    name = table_name()
    b.create_tick_table(spark, name, str(tmp_path / "t"), 8)
    assert b.append_ticks(df, name) == 3 * n
    files = [f.name.split("_")[-1].split(".")[0] for f in (tmp_path / "t").glob("*.parquet")]
    assert 8 < len(files) <= 16 and len(set(files)) == 8  # one bucket in several files
    assert spark.table(name).filter("crypto_id = 'copied'").count() == n
    cleaned = b.clean_ticks(spark.table(name))
    assert count_nodes(cleaned, "Exchange") == 0 and cleaned.count() == 2 * n + 1
    few = df.filter("crypto_id <> 'copied'")
    sizes = [r["count"] for r in by_bucket(few, 8, few).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2 * n


def test_bucketed_table_is_cleaned_without_a_shuffle(spark, tmp_path):
    name = table_name()
    b.create_tick_table(spark, name, str(tmp_path / "t"), 8)
    b.append_ticks(ticks(spark, [("a", i, 1.0) for i in range(100)]), name)
    assert count_nodes(b.clean_ticks(spark.table(name)), "Exchange") == 0


def test_layouts_of_a_snapshot_do_not_mix(spark, tmp_path):
    root = str(tmp_path)
    b.write_ticks(ticks(spark, [("a", 1, 1.0), ("b", 1, 1.0)]), root, "2024-01-01")
    with pytest.raises(ValueError, match="not split by series"):
        b.write_ticks(ticks(spark, [("a", 1, 2.0)]), root, "2024-01-01", by_series=True)
    assert rows(b.read_ticks(spark, root)) == [("a", 1, 1.0), ("b", 1, 1.0)]
    b.write_ticks(ticks(spark, [("a", 1, 2.0)]), root, "2024-01-02", by_series=True)
    b.write_ticks(ticks(spark, [("c", 1, 3.0)]), root, "2024-01-02")
    assert rows(b.read_ticks(spark, root)) == [("c", 1, 3.0)]


def test_unfinished_snapshot_and_bad_dates(spark, tmp_path):
    root = str(tmp_path)
    b.write_ticks(ticks(spark, [("a", 1, 1.0)]), root, "2024-01-01")
    (tmp_path / "ingest_date=2024-01-02" / "_temporary").mkdir(parents=True)
    (tmp_path / "ingest_date=zz").mkdir()
    assert rows(b.read_ticks(spark, root)) == [("a", 1, 1.0)]
    with pytest.raises(ValueError, match="not finished"):
        b.read_ticks(spark, root, "2024-01-02")
    with pytest.raises(ValueError):
        b.write_ticks(ticks(spark, [("a", 1, 1.0)]), root, "x")
    _, bad = b.validate_ticks(ticks(spark, [("", 1, 1.0), ("a", DAY0 * 1_000_000, 1.0)]).withColumn(
        "datetime", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")))
    assert sorted(r["reason"] for r in bad.collect()) == ["crypto_id is empty", "timestamp is out of range"]


# Runs ---------------------------------------------------------------------------------

def test_ingest_load_transform(spark, tmp_path):
    raw, out, name = str(tmp_path / "raw"), str(tmp_path / "out"), table_name()
    landed = tmp_path / "landed"
    landed.mkdir()
    docs = [{"id": c, "prices": [[DAY0 + d * MS_PER_DAY, p + d] for d in range(9)]}
            for c, p in (("a", 10), ("b", 20), ("c", 30))]
    docs.append({"id": "bad", "prices": [[DAY0]]})
    (landed / "docs.json").write_text("\n".join(map(json.dumps, docs)))
    caps = [{"id": d["id"], "market_cap": i} for i, d in enumerate(docs)]
    (tmp_path / "listing.json").write_text(json.dumps(caps))
    listing = b.read_listing(spark, str(tmp_path / "listing.json"), multiline=True)
    histories = b.read_history(spark, str(landed))

    report = b.ingest(listing, histories, raw, "2024-01-09", k=3, days=7)
    assert report.counts == {"ticks": 14, "documents_rejected": 1, "ticks_refused": 0,
                             "ticks_before": 4, "ticks_read": 18}
    assert {r["crypto_id"] for r in b.read_ticks(spark, raw).collect()} == {"b", "c"}

    b.create_tick_table(spark, name, str(tmp_path / "t"))
    assert b.load_snapshot(spark, raw, name) == 14
    assert b.load_snapshot(spark, raw, name, on_conflict="skip") == 0
    assert b.load_snapshot(spark, str(tmp_path / "none"), name) == 0

    want = model_metrics([(c, DAY0 + d * MS_PER_DAY, float(p + d), None, None)
                          for c, p in (("b", 20), ("c", 30)) for d in range(2, 9)])
    for options in ({}, {"layout": "by_bar", "ordered": True}):
        report = b.run_transform(spark, raw, out, "2024-01-10", **options)
        assert report.paths == {"daily_prices": f"{out}/run_date=2024-01-10"}
        assert report.counts == {"raw": 14, "removed": 0, "clean": 14, "bars": 14}
        got = b.read_bars(spark, out, "2024-01-10", METRICS)
        assert rows(got, *METRICS.names) == want
        assert got.schema == METRICS


def landed_inputs(spark, tmp_path):
    day = MS_PER_DAY
    docs = [
        {"id": "a", "prices": [[DAY0 + d * day, 1.0 + d] for d in range(9)]},
        {"id": "b/c", "prices": [[DAY0 + 8 * day, 2.0], [DAY0 + 20 * day, 3.0]]},
        {"id": "x" * 51, "prices": [[DAY0 + 8 * day, 2.0]]}, {"id": "bad", "prices": None}, {"id": "none"},
        {"id": "unlisted", "prices": [[DAY0, 1.0]]}]
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "d.json").write_text("\n".join(map(json.dumps, docs)))
    (tmp_path / "listing.json").write_text(json.dumps([{"id": d["id"], "market_cap": 9 - i} for i, d in enumerate(docs)]))
    return b.read_listing(spark, str(tmp_path / "listing.json"), multiline=True), b.read_history(spark, str(tmp_path / "docs"))


def test_ingest_reads_listing_and_documents_once(spark, tmp_path):
    listing, histories = landed_inputs(spark, tmp_path)
    df = judged_ticks(listing, histories, 5, end_of("2024-01-09"), 7)
    scans = [x for x in plan(df).splitlines() if "FileScan" in x]
    assert len(scans) == 2 and count_nodes(df, "Generate") == 1, plan(df)


@pytest.mark.parametrize("by_series", [False, True])
def test_ingest_writes_all_kinds_in_one_pass(spark, tmp_path, by_series):
    listing, histories = landed_inputs(spark, tmp_path)
    raw = str(tmp_path / "raw")
    counts = {"ticks": 8, "documents_rejected": 1, "ticks_refused": 2, "ticks_before": 2, "ticks_read": 12}
    for _ in range(2):  # a rerun replaces all kinds
        report = b.ingest(listing, histories, raw, "2024-01-09", 5, 7, by_series=by_series)
        assert report.counts == counts
        assert b.read_ticks(spark, raw).count() == 8 and b.snapshot_dates(spark, raw) == ["2024-01-09"]
        refused, unsound = (spark.read.parquet(report.paths[k]) for k in ("refused", "unsound"))
        assert rows(refused, "reason") == [("crypto_id is too long",), ("timestamp is later than the ingest",)]
        assert rows(unsound, "crypto_id", "reason") == [("bad", "prices are null")]
    assert all(f.startswith(report.paths["ticks"]) for f in report.files)
    if by_series:
        assert {f.split("/")[-2] for f in report.files} == {"crypto_id=a", "crypto_id=b%2Fc"}
    sound = histories.filter("id = 'a'")
    assert b.ingest(listing, sound, raw, "2024-01-09", 5, 7).counts["ticks_refused"] == 0
    assert spark.read.parquet(report.paths["refused"]).count() == 0


def test_transform_counts_what_it_removed(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    data = [("a", DAY0, 1.0), ("a", DAY0, 2.0), ("a", DAY0 + 1, -1.0), ("a", DAY0 + 2, None)]
    b.write_ticks(ticks(spark, data), raw, "2024-01-01")
    for ordered in (False, True):
        report = b.run_transform(spark, raw, out, "2024-01-01", ordered=ordered)
        assert report.counts == {"raw": 4, "removed": 3, "clean": 1, "bars": 1}


def test_counts_are_exact_when_tasks_run_again(spark, tmp_path):
    def failing_once(batches):
        """Hand the rows on, then fail if this is the task's first attempt."""
        from pyspark import TaskContext

        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")

    root = str(tmp_path)
    data = [(f"s{i % 7}", DAY0 + i * 1000, float(i + 1)) for i in range(2000)]
    flaky = ticks(spark, data).repartition(6).mapInPandas(failing_once, TICKS)
    for date, clustered in (("2024-01-01", False), ("2024-01-02", True)):
        assert b.write_ticks(flaky, root, date, clustered=clustered)[1] == 2000
        assert rows(b.read_ticks(spark, root)) == sorted(data)
    metrics = b.daily_metrics(flaky).repartition(3).mapInPandas(failing_once, METRICS)
    assert b.write_bars(metrics, root, "2024-01-01")[1:] == (7, 2000)
    assert b.read_bars(spark, root, "2024-01-01").count() == 7


def test_preview(spark):
    m = b.daily_metrics(ticks(spark, [("b", DAY0, 1.0), ("a", DAY0 + MS_PER_DAY, 3.0), ("a", DAY0, 2.0)]))
    got = b.preview(m, 2)
    assert got.columns == ["crypto_id", "date", "close", "ma_7d", "change_1d_pct", "volatility_7d"]
    assert [(r["crypto_id"], r["close"]) for r in got.collect()] == [("a", 2.0), ("a", 3.0)]


def test_command_line(spark, tmp_path):
    raw, out, name = str(tmp_path / "raw"), str(tmp_path / "out"), table_name()
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "d.json").write_text(json.dumps({"id": "a", "prices": [[DAY0, 5.0]]}))
    (tmp_path / "listing.json").write_text(json.dumps({"id": "a", "market_cap": 1}))
    assert main(["ingest", "--listing", str(tmp_path / "listing.json"), "--histories",
                 str(tmp_path / "docs"), "--raw", raw, "--date", "2024-01-01"]).counts["ticks"] == 1
    assert main(["load", "--raw", raw, "--table", name, "--on-conflict", "skip"]).counts == {"ticks": 1}
    report = main(["transform", "--raw", raw, "--out", out, "--run-date", "2024-01-02"])
    assert report.counts == {"raw": 1, "removed": 0, "clean": 1, "bars": 1}
