"""The tick table of the catalog, and its twin in a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barloom.functions.time import utc_day
from barloom.operators.cleaning import crowded, dedup_ticks, in_range, key_bucket
from barloom.operators.validation import require_contract
from barloom.schema import MAX_ID_LENGTH, TICK_KEY, TICKS, conform

LOADED_AT = "created_at"
DAY = "day"


def create_tick_table(spark: SparkSession, table: str, path: str | None = None,
                      buckets: int | None = None, by_day: bool = False) -> None:
    """Create the tick table unless it is there.

    With `buckets` the table is bucketed by the tick key: cleaning it, or looking up
    which ticks it has, then needs no shuffle of the table. The key holds the timestamp,
    so a large series spreads over all buckets.

    With `by_day` it is partitioned by the UTC day of the timestamp: a load that skips
    known ticks opens the days that the batch has, however far apart they are.
    """
    if buckets and by_day:
        raise ValueError("choose one of buckets and by_day")
    clustering = f"CLUSTERED BY ({', '.join(TICK_KEY)}) INTO {buckets} BUCKETS" if buckets else ""
    day, partitioning = (f", {DAY} DATE", f"PARTITIONED BY ({DAY})") if by_day else ("", "")
    location = f"LOCATION '{path}'" if path else ""
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {table} (
            timestamp BIGINT, datetime TIMESTAMP_NTZ, crypto_id VARCHAR({MAX_ID_LENGTH}),
            price DOUBLE, volume DOUBLE, market_cap DOUBLE, {LOADED_AT} TIMESTAMP{day})
        USING parquet {partitioning} {clustering} {location}""")


def _buckets(spark: SparkSession, table: str) -> int | None:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"]) if rows else None


def _by_day(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition and c.name == DAY for c in spark.catalog.listColumns(table))


def _table_near(table: DataFrame, raw: DataFrame) -> DataFrame:
    """The rows of a tick table that can have a key of `raw`, of which only the timestamps are read.

    By day: the days of the batch prune the table's partitions while the job runs. The list
    of days is broadcast; the calendar bounds it to 366 rows a year (3.7 million in all).
    Else: the bounds of the batch are read first and stand as literals in the filter, where
    the statistics of the table's files serve them; one old tick widens that stretch.
    """
    if DAY in table.columns:
        days = in_range(raw.select("timestamp")).select(utc_day("timestamp").alias(DAY)).distinct()
        return table.join(F.broadcast(days), DAY, "left_semi")
    low, high = raw.agg(F.min("timestamp"), F.max("timestamp")).first()
    return table.filter(F.col("timestamp").between(low, high))


def without_existing(ticks: DataFrame, table: DataFrame, buckets: int | None = None,
                     raw: DataFrame | None = None) -> DataFrame:
    """Ticks whose key is not in `table`, one per key.

    Only the part of the table that the batch can touch is looked up (see `_table_near`).
    The table's keys are made distinct before they are shuffled. Both sides end up
    partitioned by the key, where they join. With the table's number of `buckets` the batch
    is dealt like the table, and the table stays where it is; its map-side step still sends
    one copy of a key from each task. `raw`: the batch before checks that read more
    columns, if there is one; its timestamps are read an additional time.
    """
    key = list(TICK_KEY)
    near = _table_near(table, ticks if raw is None else raw).select(*key)
    batch = dedup_ticks(ticks)
    if buckets:
        batch = batch.repartition(buckets, *key)
    else:
        near = near.distinct()
    return batch.join(near, key, "left_anti")


def by_bucket(batch: DataFrame, buckets: int, raw: DataFrame) -> DataFrame:
    """The batch with the rows of each bucket in one task, but for ticks with very many copies.

    Those are dealt to all tasks, so their bucket gets several files, which the table's
    readers put together. They are found in `raw`, of which the columns of the key are read.
    """
    place = F.hash(*TICK_KEY)  # what Spark deals rows to buckets by
    hot = crowded(raw)
    if hot:
        copy = F.when(key_bucket().isin(hot), F.monotonically_increasing_id()).otherwise(F.lit(0).cast("long"))
        batch = batch.withColumn("_place", F.pmod(place + copy, F.lit(buckets)).cast("int"))
    else:
        batch = batch.withColumn("_place", F.pmod(place, F.lit(buckets)))
    return batch.repartitionById(buckets, "_place").drop("_place")


def append_ticks(ticks: DataFrame, table: str, on_conflict: str = "append") -> int:
    """Append ticks to a catalog table; returns the number of rows added.

    Rows that break the table's contract are an error. `on_conflict="append"` adds every
    row, also when the batch was loaded before; `"skip"` adds only ticks whose key the
    table lacks, so that a load can be repeated.

    A table by day is written day by day: adaptive execution gives a day of many rows
    several files and packs small days into one task.
    """
    if on_conflict not in ("append", "skip"):
        raise ValueError(f"on_conflict is 'append' or 'skip', not {on_conflict!r}")
    spark = ticks.sparkSession
    raw = conform(ticks, TICKS)
    batch = require_contract(raw)
    buckets, by_day = _buckets(spark, table), _by_day(spark, table)
    if on_conflict == "skip":
        batch = without_existing(batch, spark.table(table), buckets, raw)
    elif buckets:
        # One file per bucket instead of one per bucket and task.
        batch = by_bucket(batch, buckets, raw)
    seen = Observation()
    out = batch.select(TICKS.names).withColumn(LOADED_AT, F.current_timestamp())
    if by_day:
        out = out.withColumn(DAY, utc_day("timestamp")).hint("rebalance", DAY)
    out.observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(table)
    return seen.get["rows"]


def append_ticks_jdbc(ticks: DataFrame, url: str, table: str, properties: dict | None = None,
                      connections: int = 8) -> int:
    """Append ticks to a database table through JDBC; returns the number of rows sent.

    The database fills its own key and load time. `connections` is the number of writers;
    rows are dealt to them, so that reading and checking keep their own tasks. A task that runs again may send its rows again; let the table's own unique
    key, or a staging table, deal with that.
    """
    batch = require_contract(conform(ticks, TICKS))
    seen = Observation()
    batch.repartition(connections).observe(seen, F.count(F.lit(1)).alias("rows")).write.option(
        "numPartitions", connections).jdbc(url, table, mode="append", properties=properties or {})
    return seen.get["rows"]
