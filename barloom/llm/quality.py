"""Quality classifier by importance resampling: hashed n-gram models and Gumbel top-k."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, id_text, in_slices, stored, table

BUCKETS = 1 << 14
PRIOR = 50.0
MAX_LABELLED = 200_000
MARGIN = 7.0
_TOKEN = re.compile(rb"[\w\x80-\xff]+|[^\w\s\x80-\xff]+")


def _hashes(text: str) -> np.ndarray:
    """Buckets of the words and marks of a text and of their pairs."""
    tokens = _TOKEN.findall(text.encode("utf-8", "surrogatepass"))
    h = np.fromiter(map(zlib.crc32, tokens), np.uint32, len(tokens))
    pair = (h[:-1] * np.uint32(2654435761)) ^ (h[1:] * np.uint32(40503))
    pair ^= pair >> np.uint32(15)
    pair[h[:-1] == h[1:]] = 0  # a token twice in a row is one feature, whatever the token
    return np.concatenate((h, pair)) & np.uint32(BUCKETS - 1)


def _bucket_counts(target_ids: frozenset):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for ids, texts in columns_of(batches, "doc_id", "text", rows=256):
            own = [_hashes(t) for t in texts]
            counts[0] += np.bincount(np.concatenate(own), minlength=BUCKETS)
            good = [h for i, h in zip(ids, own, strict=True) if i in target_ids]
            if good:
                counts[1] += np.bincount(np.concatenate(good), minlength=BUCKETS)
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(counts[0][at]), pa.array(counts[1][at])],
            ["bucket", "raw", "target"])
    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_labelled: int = MAX_LABELLED) -> np.ndarray:
    """log(target / raw) of every bucket.

    Raw counts cover all documents. The target model is fitted to documents labelled
    quality 1 and not toxic, at most max_labelled of them (the smallest hashes of the id; an
    id with several labels needs all of them good). A bucket's ratio is that of its count in the
    target to the count usual in raw text of that length, both with PRIOR added: what is rare
    tells little, and without labels every ratio is 0.
    """
    spark = docs.sparkSession
    good = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    good = good.where((F.col("quality") == 1) & (F.col("toxic") == 0)).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(max_labelled).select("doc_id")
    ids = spark.sparkContext.broadcast(frozenset(good.toArrow().column("doc_id").to_pylist()))

    def run(batches):
        yield from _bucket_counts(ids.value)(batches)

    found = id_text(docs, id_col, text_col).mapInArrow(
        run, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.ones(BUCKETS), np.zeros(BUCKETS)
    at = found.column("bucket").to_numpy()
    raw[at] += found.column("raw").to_numpy()
    target[at] += found.column("target").to_numpy()
    raw /= raw.sum()
    usual = target.sum() * raw
    ratio = (target + PRIOR) / (usual + PRIOR)
    return np.log(ratio) - np.log((raw * ratio).sum())


def gumbel(id_col: str = "doc_id"):
    """Noise from the id's hash, so that reruns draw the same."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit("gumbel")), 11) + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def log_ratios(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, log_ratio: its text's log probability as target less that as raw."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        for ids, texts in columns_of(batches, "doc_id", "text", rows=512):
            lr = [float(shared.value[_hashes(t)].sum()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lr, pa.float64())], ["doc_id", "log_ratio"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, log_ratio double")


def top_k_threshold(keys: DataFrame, k: int, bins: int = 4096, rounds: int = 5) -> float:
    """The k-th largest key of column `key`, by histograms that narrow down to its bin."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None or k <= 0:
        return float("inf")
    above = 0
    for _ in range(rounds):
        if not high > low:
            break
        width = (high - low) / bins
        if low + width <= low:
            break
        found = keys.where(F.col("key").between(low, high)).groupBy(
            F.least(F.floor((F.col("key") - low) / width), F.lit(bins - 1)).alias("b")).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        for row in found.orderBy(F.desc("b")).collect():
            if above + row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            above += row["n"]
        else:
            return low
    return low


def resample(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
             margin: float = MARGIN) -> tuple[DataFrame, float]:
    """Per document: doc_id, log_ratio, gumbel_key, kept; and the key that the last one kept has.

    Gumbel top-k draws k documents without replacement with weights target / raw: those with
    the k largest log_ratio + Gumbel noise. k is the number of documents that are not e^margin
    times likelier as raw text than as target text. Empty and null texts have ratio 0. Rows
    of one id share their noise; equal keys at the threshold are all kept.
    """
    scored = stored(log_ratios(docs, ratio, id_col, text_col).withColumn(
        "key", F.col("log_ratio") + gumbel("doc_id")))
    k = scored.where(F.col("log_ratio") >= -margin).count()
    least = top_k_threshold(scored, k)
    return scored.select("doc_id", "log_ratio", F.col("key").alias("gumbel_key"),
                         (F.col("key") >= least).alias("kept")), least


def keep_resampled(docs: DataFrame, ratio: np.ndarray, least: float, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The rows, all columns, whose key is at least `least`; scored again rather than joined,
    so that no text is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    # Only text and noise go to Python, and a truth value comes back: rows stay where they are.
    @F.arrow_udf("boolean")
    def stays(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for part, noise in parts:
            lr = [float(shared.value[_hashes(t or "")].sum()) for texts in in_slices(part) for t in texts]
            yield pa.array(np.array(lr) + noise.to_numpy(zero_copy_only=False) >= least, pa.bool_())

    return docs.where(stays(F.col(text_col).cast("string"), gumbel(id_col)))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return resample(docs, train(docs, table(spark, sf_dir, "labels")))[0]
