"""Nested price-history documents to ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.pairs import has_time, has_value, is_point, pairs, value_at
from barloom.functions.time import utc_datetime
from barloom.schema import CORRUPT, NULL_KEYS, TICKS


def document_problem(docs: DataFrame) -> Column:
    """Why a document cannot be turned into ticks; null if it can.

    A document is taken or turned away as a whole. Members of `total_volumes` and
    `market_caps` past the last price play no part. An absent array is empty; one that is an
    explicit null (see NULL_KEYS) turns the document away, unless no price needs it.
    """
    prices = pairs("prices")

    def is_null(name: str) -> Column:
        return F.array_contains(NULL_KEYS, name) if NULL_KEYS in docs.columns else F.lit(False)

    def aligned(name: str) -> Column:
        return F.slice(pairs(name), F.lit(1), F.size(prices))

    problem = F.when(F.col("id").isNull(), "no id")
    if CORRUPT in docs.columns:
        problem = F.when(F.col(CORRUPT).isNotNull(), "not readable").when(
            F.col("id").isNull(), "no id")
    return (
        problem.when(is_null("prices"), "prices are null")
        .when(~F.forall(prices, is_point), "price is not a pair")
        .when(~F.forall(prices, has_time), "no instant")
        .when(is_null("total_volumes") & (F.size(prices) > 0), "volumes are null")
        .when(is_null("market_caps") & (F.size(prices) > 0), "market caps are null")
        .when(~F.forall(aligned("total_volumes"), has_value), "volume is not a pair")
        .when(~F.forall(aligned("market_caps"), has_value), "market cap is not a pair")
    )


def rejected_documents(docs: DataFrame) -> DataFrame:
    """(id, reason) of the documents `explode_history` leaves out."""
    return docs.select("id", document_problem(docs).alias("reason")).filter("reason IS NOT NULL")


def _points() -> Column:
    """The points of a document, put together inside the array."""
    volumes, caps = pairs("total_volumes"), pairs("market_caps")
    return F.transform(
        pairs("prices"),
        lambda p, i: F.struct(
            F.get(p, F.lit(0)).cast("long").alias("timestamp"),
            F.get(p, F.lit(1)).alias("price"),
            value_at(volumes, i).alias("volume"),
            value_at(caps, i).alias("market_cap"),
        ),
    )


def explode_history(docs: DataFrame) -> DataFrame:
    """One tick per price point of each sound document.

    The i-th price goes with the i-th volume and market cap (null past their end).
    The points are put together inside the array before it is exploded: no shuffle,
    and no row carries the document's arrays along.
    """
    sound = docs.filter(document_problem(docs).isNull())
    ticks = sound.select(F.col("id").alias("crypto_id"), F.inline(_points()))
    return ticks.withColumn("datetime", utc_datetime("timestamp")).select(TICKS.names)


# Points of a document that one row holds before it is dealt to another task.
LONG = 100_000


def explode_long_history(docs: DataFrame, points: int = LONG) -> DataFrame:
    """The rows of `explode_history`, for documents with very many points.

    A sound document is cut into ranges of `points` positions, with the volumes and market caps
    of the same positions; the ranges are dealt to tasks by id and number, one shuffle of the
    arrays, and exploded there.
    """
    prices = pairs("prices")
    last = F.greatest(F.ceil(F.size(prices) / points), F.lit(1)).cast("int") - 1
    sound = docs.filter(document_problem(docs).isNull())
    ranges = sound.select("id", *[pairs(c).alias(c) for c in ("prices", "market_caps", "total_volumes")],
                          F.explode(F.sequence(F.lit(0), last)).alias("range"))
    cut = ranges.select("id", "range", *[
        F.slice(c, F.col("range") * points + 1, points).alias(c) for c in ("prices", "market_caps", "total_volumes")])
    return explode_history(cut.repartition("id", "range").drop("range"))


def explode_with_rejects(docs: DataFrame) -> DataFrame:
    """The rows of `explode_history`, and one row (crypto_id, `problem`) of each unsound document."""
    kind = "array<struct<timestamp: bigint, price: double, volume: double, market_cap: double>>"
    judged = docs.withColumn("problem", document_problem(docs))
    points = F.when(F.col("problem").isNull(), _points()).otherwise(F.array(F.lit(None)).cast(kind))
    rows = judged.select(F.col("id").alias("crypto_id"), "problem", F.inline(points))
    return rows.withColumn("datetime", utc_datetime("timestamp")).select(*TICKS.names, "problem")


def history_points(docs: DataFrame) -> DataFrame:
    """Price points per series, over all its documents, sound or not."""
    return docs.groupBy("id").agg(F.sum(F.size(pairs("prices"))).alias("points"))
