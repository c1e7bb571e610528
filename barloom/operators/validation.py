"""The contract of the tick table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.time import FIRST_MS, LAST_MS
from barloom.schema import MAX_ID_LENGTH


def contract_breach() -> Column:
    """Which rule of the tick table a row breaks first; null if none."""
    return (
        F.when(F.col("timestamp").isNull(), "timestamp is null")
        .when(F.col("datetime").isNull(), "datetime is null")
        .when(F.col("crypto_id").isNull(), "crypto_id is null")
        .when(F.length("crypto_id") > MAX_ID_LENGTH, "crypto_id is too long")
        .when(F.col("crypto_id") == "", "crypto_id is empty")
        .when(~F.col("timestamp").between(FIRST_MS, LAST_MS), "timestamp is out of range")
    )


def validate_ticks(ticks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows the table takes, rows it does not take with their `reason`)."""
    breach = contract_breach()
    good = ticks.filter(breach.isNull())
    rejects = ticks.withColumn("reason", breach).filter("reason IS NOT NULL")
    return good, rejects


def require_contract(ticks: DataFrame) -> DataFrame:
    """The same rows; a row that breaks the contract fails the job that reads it."""
    breach = contract_breach()
    return ticks.filter(F.assert_true(breach.isNull(), breach).isNull())
