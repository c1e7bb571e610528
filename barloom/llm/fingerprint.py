"""Document fingerprints by consistent weighted sampling over word n-grams."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, table, worker_cache
from .jaccard import _M1, _M2, _mixed, _ngrams, _word_hashes

SAMPLES = 128
SHINGLE = 3
SEED = 20_240_601
_BLOCK = 512


class Sampler:
    """Signatures whose collision rate is the generalised Jaccard similarity (sum of minima
    over sum of maxima) of two texts' weighted terms.

    A term is the 64-bit hash of a word n-gram (A-Z in lower case); its weight is how often it
    occurs. For sample k and term i, r and c are Gamma(2, 1) and beta is uniform on (0, 1), the
    same in every text. With t = floor(ln w / r + beta) and ln y = r (t - beta), the term with
    the least ln c - ln y - r is drawn, and (i, t) is the sample.

    They come from three exponentials e, f, q, drawn by a hash of (k, i): c = e + f,
    r = ln(c / e) + q, beta = q / r have just these distributions, and the value becomes
    ln e - r t. A term of weight 1 has t = 0, so most terms need one draw and no logarithm.
    """

    def __init__(self, samples: int = SAMPLES, shingle: int = SHINGLE, seed: int = SEED):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.samples, self.shingle = samples, shingle
        self.keys = rng.integers(0, 1 << 32, (3, samples, 1), np.uint32)
        self.each = np.arange(samples)
        self.room = np.empty((2, samples * _BLOCK), np.uint32)

    def terms(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        h = _word_hashes(text)
        if not len(h):
            return h, np.zeros(0, np.int64)
        return np.unique(_ngrams(h, self.shingle), return_counts=True)

    def _draw(self, which: int, terms: np.ndarray) -> np.ndarray:
        """32 random bits for each (sample, term), all 64 bits of the term mixed in; in a room
        that the next draw takes."""
        low, high = terms.astype(np.uint32), (terms >> np.uint64(32)).astype(np.uint32)
        x, y = (r[:self.samples * len(terms)].reshape(self.samples, -1) for r in self.room)
        np.bitwise_xor(low, self.keys[which], out=x)
        for shift, by in ((15, 0x2C1B3C6D), (13, 0x85EBCA6B), (16, 0x9E3779B1)):
            np.multiply(x, np.uint32(by), out=x)
            np.bitwise_xor(x, np.right_shift(x, np.uint32(shift), out=y), out=x)
            if shift == 15:
                np.add(x, high, out=x)
        return x

    @staticmethod
    def _exponential(bits: np.ndarray) -> np.ndarray:
        return -np.log1p(-(bits + 0.5) / 2.0**32)

    def _once(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least values of terms of weight 1, and whose they are."""
        least, own = np.full(self.samples, 0xFFFFFFFF, np.uint32), np.full(self.samples, terms[0])
        for lo in range(0, len(terms), _BLOCK):
            x = self._draw(0, terms[lo:lo + _BLOCK])
            at = x.argmin(axis=1)
            found = x[self.each, at]
            less = found < least
            least[less], own[less] = found[less], terms[lo + at[less]]
        return np.log(self._exponential(least)), own

    def signature(self, text: str) -> np.ndarray:
        """16 bits for each sample; all ones for a text without words."""
        terms, w = self.terms(text)
        if not len(terms):
            return np.full(self.samples, 0xFFFF, np.uint16)
        one, more, log_w = terms[w == 1], terms[w > 1], np.log(w[w > 1])
        best, own, level = np.full(self.samples, np.inf), np.full(self.samples, terms[0]), np.zeros(self.samples)
        if len(one):
            best, own = self._once(one)
        for lo in range(0, len(more), _BLOCK):
            some = more[lo:lo + _BLOCK]
            e, f, q = (self._exponential(self._draw(i, some)) for i in range(3))
            r = np.log1p(f / e) + q
            t = np.floor((log_w[lo:lo + _BLOCK] + q) / r)
            value = np.log(e) - r * t
            at = value.argmin(axis=1)
            found = value[self.each, at]
            less = found < best
            best[less], own[less], level[less] = found[less], some[at[less]], t[self.each, at][less]
        # (term, t) goes to 16 bits: unequal samples meet with a chance of 1 in 65,536
        return (_mixed(_mixed(own, _M1) + level.astype(np.uint64), _M2) >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def _in_order(samples: int, shingle: int):
    """Rows come sorted by bucket, id and text; each is followed by the next document, if only
    as a guest (role > 0) from the bucket after it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("sampler")
        if (samples, shingle) not in cache:
            cache[samples, shingle] = Sampler(samples, shingle)
        sampler = cache[samples, shingle]
        last = None  # bucket, doc_id, text, signature
        out: list[tuple] = []

        def row(following: str, following_signature: np.ndarray) -> tuple:
            _, doc_id, text, own = last
            n = len(text)
            edited = text[:n - n // 2] + following[:n // 2]
            changed = sampler.signature(edited)
            return (doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                    own.astype(">u2").tobytes().hex(), changed.astype(">u2").tobytes().hex(),
                    likeness(own, changed), likeness(own, following_signature))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                 "near_edited", "near_next"])

        for buckets, roles, ids, texts in columns_of(batches, "bucket", "role", "doc_id", "text"):
            for bucket, role, doc_id, text in zip(buckets, roles, ids, texts, strict=True):
                own = sampler.signature(text)
                if last and last[0] == bucket:
                    out.append(row(text, own))
                last = None if role else (bucket, doc_id, text, own)
                if len(out) >= 1000:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)
    return run


def _dealt(cuts: np.ndarray, guests: dict[int, list[int]]):
    """Rows (bucket, role, k, doc_id, text); a bucket's first document goes to the one before too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column(batch.schema.get_field_index("k")).to_numpy(zero_copy_only=False)
            bucket = np.searchsorted(cuts, k)
            of = [(r, b) for r, x in enumerate(k.tolist()) for b in guests.get(x, ())]
            rows = np.concatenate((np.arange(len(k)), np.array([r for r, _ in of], np.int64)))
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((bucket, np.array([b for _, b in of], np.int64)))),
                 pa.array(np.concatenate((np.zeros(len(k), np.int32), np.ones(len(of), np.int32)))),
                 *[taken.column(taken.schema.get_field_index(c)) for c in ("k", "doc_id", "text")]],
                ["bucket", "role", "k", "doc_id", "text"])
    return run


def _firsts(cuts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, int] = {}
        for (ids,) in columns_of(batches, "k"):
            k = np.array(ids, np.int64)
            for b, x in zip(np.searchsorted(cuts, k).tolist(), ids, strict=True):
                if x < least.get(b, x + 1):
                    least[b] = x
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(least), pa.int64()), pa.array(list(least.values()), pa.int64())], ["bucket", "k"])
    return run


def fingerprints(docs: DataFrame, samples: int = SAMPLES, shingle: int = SHINGLE, rows_in_bucket: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many
    (or all) of the next document in ascending doc_id; the last is followed by the first.

    Ids are cut into buckets of about rows_in_bucket documents at approximate quantiles of the
    ids alone; texts are shuffled once, by bucket, and read in order as a stream. The first
    document of each bucket is also sent to the end of the bucket before it; the driver sees
    one id a bucket.

    Null texts count as empty; an empty text's fingerprint is all ones and like any other
    empty one's. Null ids come first. Rows of one id follow each other by text, so the result
    doesn't hang on their order. A single document follows itself; an empty table is empty.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("k"),
                       F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    buckets = max(1, rows.count() // rows_in_bucket)
    found = None
    if buckets > 1:
        found = rows.agg(F.percentile_approx("k", [i / buckets for i in range(1, buckets)],
                                             max(10_000, 4 * buckets))).first()[0]
    cuts = np.unique(np.array(found or [], np.int64))
    firsts = rows.select("k").mapInArrow(_firsts(cuts), "bucket long, k long").groupBy("bucket").agg(
        F.min("k").alias("k")).orderBy("bucket").collect()
    guests: dict[int, list[int]] = {}
    for i, r in enumerate(firsts):
        guests.setdefault(r["k"], []).append(firsts[i - 1]["bucket"])
    dealt = rows.mapInArrow(_dealt(cuts, guests), "bucket long, role int, k long, doc_id long, text string")
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "role", "k", "text")
    return dealt.select("bucket", "role", "doc_id", "text").mapInArrow(
        _in_order(samples, shingle),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def op4_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
