"""A corpus from documents: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import jaccard, langid, mixing, packing, quality
from barloom.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letter, no language with a probability of a half, or far
    more bits a byte than their language's training texts."""
    model = langid.train(docs)
    return langid.keep_identified(docs, model, limits=langid.rate_limits(docs, model))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the resampling to good text leaves out."""
    ratio = quality.train(docs, table(spark, sf_dir, "labels"))
    _, least = quality.resample(docs, ratio)
    return quality.keep_resampled(docs, ratio, least)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by similarity 0.8 of five-word shingles."""
    return jaccard.keep_one(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    taken = mixing.mix(docs, keep=docs.columns)
    often = taken.where(F.col("copies") > 0).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return often.select("_kept.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Language models, resampling and packing have no form in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
