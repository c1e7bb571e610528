"""The given tables as ticks, history documents and listings.

Prices are whole cents held in doubles: sums of them are exact in any order, so a
result does not depend on how Spark or the checking engine splits the work. Price, volume
and market cap of an event all differ, so that no column can stand in for another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.time import epoch_ms, utc_datetime
from barloom.operators.cleaning import IN_RANGE
from barloom.schema import NULL_KEYS, TICKS

# Events per page of a history document. Event ids are unique, so no document holds
# more points than this, however many events a user has.
PAGE = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str) -> Column:
    return F.floor(F.col(c) * 100 + 0.5).cast("double")


def props_number() -> Column:
    """The number in an event's props, 0 to 99; it decides which defect a row gets."""
    return F.regexp_extract("props", "([0-9]+)", 1).cast("int")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("user_id").cast("string").alias("uid"),
        epoch_ms("ts").alias("ms"), cents("value").alias("cents"), props_number().alias("k")).withColumns({
            "size": F.col("cents") + F.col("event_id") % 7 + 1, "cap": F.col("cents") * 3 + F.col("event_id") % 11})


def _ticks(df: DataFrame, series: str) -> DataFrame:
    return df.select(
        F.col("ms").alias("timestamp"), utc_datetime("ms").alias("datetime"),
        F.col(series).alias("crypto_id"), F.col("cents").alias("price"),
        F.col("size").alias("volume"), F.col("cap").alias("market_cap"))


def ticks_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few series without gaps: one per event type."""
    return _ticks(_events(spark, sf_dir), "event_type")


def ticks_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many series, some days missing: one per user."""
    return _ticks(_events(spark, sf_dir), "uid")


def _line_ticks(lines: DataFrame) -> DataFrame:
    return lines.select(
        epoch_ms("l_shipdate").alias("timestamp"),
        F.col("l_shipdate").alias("datetime"),
        F.col("l_partkey").cast("string").alias("crypto_id"),
        cents("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("volume"),
        cents("l_extendedprice").alias("market_cap"))


def ticks_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Very many, very gappy series over seven years, with repeated keys: one per part."""
    return _line_ticks(table(spark, sf_dir, "lineitem"))


def returned_ticks_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The returned lines of `ticks_by_part`: an earlier, smaller load of the same series."""
    return _line_ticks(table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'"))


# Row defects, and the second rows some keys get, by the number in the props.
_PRICE = """CASE WHEN k BETWEEN 6 AND 8 THEN NULL WHEN k BETWEEN 9 AND 11 THEN double('NaN')
                 WHEN k BETWEEN 12 AND 14 THEN -cents WHEN k BETWEEN 15 AND 17 THEN 0D
                 ELSE cents END AS price"""
_VOLUME = "CASE WHEN k NOT BETWEEN 20 AND 39 THEN size END AS volume"
# Instants in nanoseconds, which no calendar shows.
_INSTANT = """CASE WHEN k BETWEEN 18 AND 19 THEN ms * 1000000 WHEN k NOT BETWEEN 3 AND 5 THEN ms END AS timestamp"""
_ROWS = """inline(CASE
    WHEN k BETWEEN 50 AND 59 THEN array(struct(price, volume), struct(price, double(NULL) AS volume))
    WHEN k BETWEEN 60 AND 69 THEN array(struct(price, volume), struct(price, volume))
    WHEN k BETWEEN 70 AND 79 THEN array(struct(price, volume), struct(price, volume + 1 AS volume))
    WHEN k BETWEEN 80 AND 89 THEN array(struct(price, volume), struct(-1D AS price, volume))
    WHEN k >= 90 THEN array(struct(price, volume), struct(price + 1 AS price, double(NULL) AS volume))
    ELSE array(struct(price, volume)) END)"""


def dirty_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events by user, some with a defect, some with a second row of the same key."""
    return (
        _events(spark, sf_dir)
        .selectExpr(
            _INSTANT, "CASE WHEN k >= 3 THEN uid END AS crypto_id",
            _PRICE, _VOLUME, "cap AS market_cap", "k")
        .selectExpr("timestamp", "crypto_id", "market_cap", _ROWS)
        .select("timestamp", utc_datetime(F.expr(f"CASE WHEN {IN_RANGE} THEN timestamp END")).alias("datetime"),
                "crypto_id", "price", "volume", "market_cap")
    )


def contract_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events by user, some of them against the contract of the tick table."""
    return (
        _events(spark, sf_dir).withColumn("at", utc_datetime("ms"))
        .selectExpr(
            "CASE WHEN k >= 3 THEN ms END AS timestamp",
            "CASE WHEN k NOT BETWEEN 3 AND 5 THEN at END AS datetime",
            """CASE WHEN k BETWEEN 6 AND 8 THEN NULL WHEN k BETWEEN 9 AND 11 THEN lpad(uid, 51, '0')
                    WHEN k BETWEEN 12 AND 14 THEN lpad(uid, 50, '0') ELSE uid END AS crypto_id""",
            "cents AS price", "size AS volume", "cap AS market_cap")
    )


def histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History documents: one per user and page of events, some of them unsound.

    Volumes end two points early, market caps run one point over. Some lack their prices,
    some hold a null in their place.
    """
    docs = (
        _events(spark, sf_dir)
        .groupBy("uid", F.expr(f"event_id div {PAGE}").alias("page"))
        .agg(
            F.sort_array(F.collect_list(F.struct("ms", "event_id", "cents"))).alias("points"),
            F.min_by("k", "event_id").alias("k"),
        )
    )
    k, n, pairs = F.col("k"), F.col("n"), F.col("pairs")
    none = F.lit(None).cast("double")
    head, tail = F.element_at(pairs, 1), F.slice(pairs, F.lit(2), n)
    short = F.slice(head, 1, 1)
    untimed = F.array(none, F.element_at(head, 2))
    volumes = F.slice(pairs, F.lit(1), F.greatest(n - 2, F.lit(0)))
    return (
        docs.select(
            F.col("uid").alias("id"), "k", F.size("points").alias("n"),
            F.transform("points", lambda p: F.array(p["ms"].cast("double"), p["cents"])).alias("pairs"))
        .select(
            "id",
            F.when(k < 5, F.lit(None).cast("array<array<double>>"))
            .when(k.between(5, 9), F.concat(F.array(short), tail))
            .when(k.between(10, 14), F.concat(F.array(untimed), tail))
            .otherwise(pairs).alias("prices"),
            F.concat(pairs, F.array(F.array(F.lit(0.0), F.lit(0.0)))).alias("market_caps"),
            F.when(k.between(15, 19) & (n > 2),
                   F.concat(F.array(short), F.slice(volumes, F.lit(2), n)))
            .otherwise(volumes).alias("total_volumes"),
            F.when(k.between(3, 4), F.array(F.lit("prices"))).otherwise(F.array().cast("array<string>")).alias(NULL_KEYS))
    )


def landed(docs: DataFrame) -> DataFrame:
    """The documents as lines of JSON: a null of NULL_KEYS is written, a missing key is not."""
    keys = F.struct(*[c for c in docs.columns if c != NULL_KEYS])
    return docs.select(F.when(F.size(NULL_KEYS) > 0, F.to_json(keys, {"ignoreNullFields": "false"}))
                       .otherwise(F.to_json(keys)).alias("value"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market listing of the users; the sum of a user's values stands for the market cap."""
    return (
        _events(spark, sf_dir).groupBy("uid")
        .agg(F.max_by("cents", "event_id").alias("current_price"), F.sum("cents").alias("market_cap"))
        .select(F.col("uid").alias("id"), F.concat(F.lit("u"), "uid").alias("symbol"),
                "current_price", "market_cap"))


def fractional_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines by part with three different columns that are no whole cents."""
    return table(spark, sf_dir, "lineitem").select(
        epoch_ms("l_shipdate").alias("timestamp"), F.col("l_shipdate").alias("datetime"),
        F.col("l_suppkey").cast("string").alias("crypto_id"), cents("l_extendedprice").alias("price"),
        (F.col("l_quantity") + F.col("l_discount") / 3).alias("volume"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("market_cap"))


def messy_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing with a second row for some ids, and caps that are no number or missing."""
    known = listing(spark, sf_dir)
    kind = F.col("id").cast("int") % 7
    cap = F.when(kind == 1, F.lit(float("nan"))).when(kind != 2, F.col("market_cap"))
    again = known.filter("cast(id as int) % 7 = 3").withColumn("market_cap", F.col("market_cap") / 2)
    return known.withColumn("market_cap", cap).unionByName(again)
