"""Landed JSON: price-history documents and market listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schema import CORRUPT, HISTORY, LISTING, NULL_KEYS

_ARRAYS = [f for f in HISTORY.fields if f.name != "id"]
# What a VARIANT that holds an array of arrays of numbers and nulls is called.
_FITS = r"^ARRAY<(VOID|ARRAY<(VOID|BIGINT|FLOAT|DOUBLE|DECIMAL\(\d+,\d+\))>)>$"


def read_history(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """History documents, one JSON object per line (or per file with `multiline`).

    A missing key is a null array, and so is an explicit null, whose key is named in the
    NULL_KEYS column as well. A document that does not fit the schema comes with
    its text (or that of the array that does not fit) in the corrupt-record column, and ends
    among the rejected ones. The id may also be a folder level (`id=<series>/`).

    The arrays are read as VARIANT, which tells a null from an absent key.
    """
    fields = [T.StructField(f.name, T.VariantType()) for f in _ARRAYS]
    schema = T.StructType([HISTORY["id"], *fields, T.StructField(CORRUPT, T.StringType())])
    docs = (
        spark.read.schema(schema)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path, multiLine=multiline)
    )
    read = docs.select("*", *[
        F.try_variant_get(f.name, "$", f.dataType.simpleString()).alias(f"_{f.name}") for f in _ARRAYS])
    unfit = [F.when(~F.is_variant_null(f.name) & ~F.schema_of_variant(f.name).rlike(_FITS), F.to_json(f.name))
             for f in _ARRAYS]
    nulls = [F.when(F.col(f.name).isNotNull() & F.is_variant_null(f.name), F.lit(f.name)) for f in _ARRAYS]
    return read.select(
        "id", *[F.col(f"_{f.name}").alias(f.name) for f in _ARRAYS],
        F.coalesce(CORRUPT, *unfit).alias(CORRUPT), F.array_compact(F.array(*nulls)).alias(NULL_KEYS))


def read_listing(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Market listing: JSON objects by line, or an array of them with `multiline`."""
    return spark.read.schema(LISTING).json(path, multiLine=multiline)
