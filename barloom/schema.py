"""Explicit schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PAIRS = T.ArrayType(T.ArrayType(T.DoubleType()))

# One row per series and instant. `timestamp` is epoch milliseconds, `datetime`
# the same instant as UTC wall clock.
TICKS = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("crypto_id", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
])

# One document per series (or per page of a series): arrays of [epoch ms, value].
CORRUPT = "_corrupt_record"
# Names of the arrays that a landed document holds as an explicit null.
NULL_KEYS = "_null_keys"
HISTORY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("prices", _PAIRS),
    T.StructField("market_caps", _PAIRS),
    T.StructField("total_volumes", _PAIRS),
])

LISTING = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("current_price", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
])

# One row per series and UTC day.
BARS = T.StructType([
    T.StructField("crypto_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("data_points", T.LongType()),
])

METRICS = T.StructType(BARS.fields + [
    T.StructField("ma_7d", T.DoubleType()),
    T.StructField("ma_30d", T.DoubleType()),
    T.StructField("change_1d_pct", T.DoubleType()),
    T.StructField("change_7d_pct", T.DoubleType()),
    T.StructField("volatility_7d", T.DoubleType()),
])

# Columns a tick cannot do without.
CRITICAL = ("crypto_id", "timestamp", "price")

# The key of a tick. The timestamp leads: sorts then compare a long first and
# seldom reach the id, however few series (and however long a shared id prefix)
# there are.
TICK_KEY = ("timestamp", "crypto_id")

# Fixed value: longest id the tick table takes.
MAX_ID_LENGTH = 50


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project `df` on `schema`, by name; a missing column is an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; got {df.columns}")
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField) -> Column:
        c = F.col(field.name)
        if have[field.name] == field.dataType:
            return c
        return c.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])
