"""A session with settings that suit the jobs. Jobs work with any other session too."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Shuffled bytes one task is to take.
BYTES_PER_TASK = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, least: int = 200) -> int:
    """Number of shuffle partitions for an input of this size.

    Adaptive execution joins partitions that turn out small; it does not split those of
    an aggregate or window that turn out large, so the number errs on the high side.
    """
    return max(least, -(-input_bytes // BYTES_PER_TASK))


def get_session(app_name: str = "barloom", master: str | None = None,
                input_bytes: int | None = None, **conf) -> SparkSession:
    """Create the session, or get the running one.

    `conf` keys are Spark settings with `__` for the dots, and win over the defaults.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.default": "parquet",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark
