from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

import barloom as b
from barloom.functions.pairs import MAX_MS
from barloom.operators.history import explode_with_rejects
from barloom.schema import HISTORY, TICKS
from helpers import DAY0, count_nodes, plan


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), HISTORY)


def points(df):
    return sorted(tuple(r) for r in df.select(
        "crypto_id", "timestamp", "price", "volume", "market_cap").collect())


def test_values_go_together_by_position(spark):
    doc = ("a", [[1.0, 10.0], [2.0, 20.0], [3.0, 30.0]],
           [[7.0, 1.0], [8.0, 2.0], [9.0, 3.0], [9.0, 4.0]], [[5.0, 100.0]])
    df = b.explode_history(docs(spark, doc))
    assert df.columns == TICKS.names
    assert [t for _, t in df.dtypes] == [f.dataType.simpleString() for f in TICKS.fields]
    assert points(df) == [("a", 1, 10.0, 100.0, 1.0), ("a", 2, 20.0, None, 2.0),
                          ("a", 3, 30.0, None, 3.0)]


def test_missing_keys(spark):
    df = docs(spark, ("a", None, [[1.0, 1.0]], None), ("b", [], None, None),
              ("c", [[1.0, 2.0]], None, None))
    assert points(b.explode_history(df)) == [("c", 1, 2.0, None, None)]
    assert b.rejected_documents(df).count() == 0
    assert {tuple(r) for r in b.history_points(df).collect()} == {("a", 0), ("b", 0), ("c", 1)}


@pytest.mark.parametrize(("prices", "caps", "volumes", "reason"), [
    ([[1.0, 2.0], [3.0]], None, None, "price is not a pair"),
    ([[1.0, 2.0, 3.0]], None, None, "price is not a pair"),
    ([None], None, None, "price is not a pair"),
    ([[None, 2.0]], None, None, "no instant"),
    ([[float("nan"), 2.0]], None, None, "no instant"),
    ([[float(MAX_MS) * 10, 2.0]], None, None, "no instant"),
    ([[1.0, 2.0]], None, [[1.0]], "volume is not a pair"),
    ([[1.0, 2.0]], None, [None], "volume is not a pair"),
    ([[1.0, 2.0]], [[]], None, "market cap is not a pair"),
])
def test_unsound_document_goes_as_a_whole(spark, prices, caps, volumes, reason):
    df = docs(spark, ("bad", prices, caps, volumes), ("good", [[1.0, 2.0]], None, None))
    assert points(b.explode_history(df)) == [("good", 1, 2.0, None, None)]
    assert [tuple(r) for r in b.rejected_documents(df).collect()] == [("bad", reason)]


def test_document_without_id(spark):
    df = docs(spark, (None, [[1.0, 2.0]], None, None))
    assert [tuple(r) for r in b.rejected_documents(df).collect()] == [(None, "no id")]
    assert b.explode_history(df).count() == 0


def test_surplus_members_are_not_looked_at(spark):
    df = docs(spark, ("a", [[1.0, 2.0]], [[1.0, 1.0], []], [[1.0, 1.0], None]))
    assert points(b.explode_history(df)) == [("a", 1, 2.0, 1.0, 1.0)]


def test_null_price_is_a_tick_to_clean(spark):
    df = b.explode_history(docs(spark, ("a", [[1.0, None]], None, None)))
    assert points(df) == [("a", 1, None, None, None)]
    assert b.clean_ticks(df).count() == 0


def test_landed_json(spark, tmp_path):
    lines = [
        json.dumps({"id": "a", "prices": [[DAY0, 5], [DAY0 + 1, 6.5]], "total_volumes": [[DAY0, 1]]}),
        json.dumps({"id": "b"}),
        json.dumps({"id": "c", "prices": "none"}),
        '{"id": "d", "prices": [[1, 2',
        json.dumps({"id": "e", "prices": [[1.0]], "extra": {"x": 1}}),
    ]
    (tmp_path / "docs.json").write_text("\n".join(lines))
    df = b.read_history(spark, str(tmp_path))
    assert points(b.explode_history(df)) == [("a", DAY0, 5.0, 1.0, None), ("a", DAY0 + 1, 6.5, None, None)]
    rejects = {(r["id"], r["reason"]) for r in b.rejected_documents(df).collect()}
    assert {r for r in rejects if r[1] != "not readable"} == {("e", "price is not a pair")}
    assert sum(r[1] == "not readable" for r in rejects) == 2


def test_landed_json_with_id_folders(spark, tmp_path):
    folder = tmp_path / "id=0042"
    folder.mkdir()
    (folder / "history.json").write_text(json.dumps({"prices": [[DAY0, 5.0]]}, indent=1))
    df = b.read_history(spark, str(tmp_path), multiline=True)
    assert points(b.explode_history(df)) == [("0042", DAY0, 5.0, None, None)]


def test_listing_array(spark, tmp_path):
    rows = [{"id": "x", "symbol": "s", "current_price": 1, "market_cap": 5, "other": True},
            {"id": "y", "market_cap": 7.5}]
    (tmp_path / "listing.json").write_text(json.dumps(rows))
    df = b.read_listing(spark, str(tmp_path), multiline=True)
    assert [tuple(r) for r in b.top_k(df, 1).collect()] == [("y", None, None, 7.5)]


def test_no_shuffle(spark):
    df = b.explode_history(docs(spark, ("a", [[1.0, 2.0]], None, None)))
    assert count_nodes(df, "Exchange") == 0
    assert "Python" not in plan(df)


def test_null_is_not_a_missing_key(spark, tmp_path):
    point = [[DAY0, 5.0]]
    landed = {
        "absent": {}, "null": {"prices": None}, "none": {"prices": []},
        "null volumes": {"prices": point, "total_volumes": None}, "null caps": {"prices": point, "market_caps": None},
        "nulls unused": {"prices": [], "total_volumes": None, "market_caps": None},
        "null first": {"prices": None, "total_volumes": None}, "inside": {"prices": [None], "market_caps": []},
        "whole": {"prices": [[DAY0, 7]], "total_volumes": [[DAY0, 1e300]], "market_caps": [[DAY0, 0.1]]},
        "text": {"prices": [[DAY0, "x"]]}, "object": {"market_caps": {"a": 1}, "prices": point}}
    (tmp_path / "d.json").write_text("\n".join(json.dumps({"id": k, **v}) for k, v in landed.items()))
    df = b.read_history(spark, str(tmp_path))
    assert {r["id"]: r["reason"] for r in b.rejected_documents(df).collect()} == {
        "null": "prices are null", "null volumes": "volumes are null", "null caps": "market caps are null",
        "null first": "prices are null", "inside": "price is not a pair", "text": "not readable", "object": "not readable"}
    assert points(b.explode_history(df)) == [("whole", DAY0, 7.0, 1e300, 0.1)]
    assert {r["id"]: r["points"] for r in b.history_points(df).collect()}["absent"] == 0
    tagged = explode_with_rejects(df).collect()
    assert sorted((r["crypto_id"], r["problem"]) for r in tagged if r["problem"]) == sorted(
        (r["id"], r["reason"]) for r in b.rejected_documents(df).collect())
    assert [tuple(r)[:-1] for r in tagged if not r["problem"]] == [tuple(r) for r in b.explode_history(df).collect()]


def test_long_document_is_exploded_by_several_tasks(spark):
    n = 200_000
    doc = spark.range(1).select(
        F.lit("a").alias("id"), *[F.transform(F.sequence(F.lit(1), F.lit(m)), lambda i: F.array(i.cast("double"), i * k)).alias(c)
                                  for c, m, k in (("prices", n, 2.0), ("market_caps", n + 9, 3.0), ("total_volumes", n - 5, 4.0))])
    some = doc.unionByName(docs(spark, ("b", [[1.0, 2.0]], None, [[1.0, 5.0]]), ("c", None, None, None), ("d", [[1.0]], None, None)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        long = b.explode_long_history(some, 10_000)
        tasks = long.filter("crypto_id = 'a'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 0.5 * n
    whole = b.explode_history(some)
    assert long.exceptAll(whole).count() == 0 and whole.exceptAll(long).count() == 0
