"""Language ID by prediction by partial matching: code lengths under one byte model a language."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, id_crc, id_text, in_slices, table

ORDER = 3
MAX_NODES = 200_000
MAX_LANGUAGES = 512
SLACK_BITS = 64
_SLOT_BITS = 21
_MARK = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether a text has a letter; numbers in circles, fractions and such are none."""
    return any(m.group().isalpha() for m in _MARK.finditer(text or ""))


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with the three before it as one number, and where each text's bytes begin.

    Lower case; each text is preceded by three spaces, which are context only.
    """
    raw = [b"   " + t.lower().encode("utf-8", "surrogatepass") for t in texts]
    b = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    if not len(b):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    code = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
    lengths = np.array([len(r) for r in raw])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    inside = np.ones(len(b), bool)
    inside[(starts[:, None] + np.arange(3)).ravel()] = False
    return code[inside[3:]], np.concatenate(([0], np.cumsum(lengths - 3)))


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task; its own counts are summed before they are sent."""
    held: dict[str, list] = {}
    size = 0

    def out():
        for lang, parts in held.items():
            keys, n = _merge(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(n)],
                ["lang", "gram", "n"])

    for langs, texts in columns_of(batches, "lang", "text", rows=512):
        by: dict[str, list[str]] = {}
        for lang, text in zip(langs, texts, strict=True):
            by.setdefault(lang, []).append(text)
        for lang, some in by.items():
            codes, _ = _grams(some)
            keys, n = np.unique(codes, return_counts=True)
            parts = held.setdefault(lang, [])
            parts.append((keys, n))
            if len(parts) > 8:
                held[lang] = [_merge(parts)]
        size = sum(len(k) for parts in held.values() for k, _ in parts)
        if size > 4_000_000:
            yield from out()
            held = {}
    yield from out()


class ByteModel:
    """The frozen context trees of all languages, as code lengths of the grams any of them has.

    Escapes by method C: in a context seen n times with d different bytes a byte seen c
    times costs -log2(c / (n + d)), and an unseen one -log2(d / (n + d)) plus its cost in the
    context that is one byte shorter; below the empty context all 256 bytes are equal.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        self.trees = [self._tree(*counts[lang]) for lang in self.langs]
        every = [np.zeros(0, np.int64)] + [t[ORDER][0] for t in self.trees]
        self.keys = np.unique(np.concatenate(every)).astype(np.uint32)
        self.costs = self._costs(self.keys.astype(np.int64))
        self.slots = np.zeros(1 << _SLOT_BITS, np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(self.keys))

    @classmethod
    def of(cls, state: dict) -> ByteModel:
        """The model again from vars(model), which any executor can unpickle."""
        model = cls.__new__(cls)
        model.__dict__.update(state)
        return model

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(2654435761)) >> np.uint32(32 - _SLOT_BITS)

    @staticmethod
    def _tree(keys: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """By order: grams, their counts; contexts, their totals and numbers of bytes."""
        levels = []
        for k in range(ORDER + 1):
            grams, where = np.unique(keys & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            c = np.bincount(where, n)
            contexts, of = np.unique(grams >> 8, return_inverse=True)
            levels.append((grams, c, contexts, np.bincount(of, c), np.bincount(of)))
        return levels

    def _costs(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty((len(codes), len(self.langs)), np.float32)
        for j, levels in enumerate(self.trees):
            cost = np.full(len(codes), 8.0)
            for k, (grams, c, contexts, total, different) in enumerate(levels):
                gram = codes & ((1 << 8 * (k + 1)) - 1)
                at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
                seen = grams[at] == gram
                of = np.minimum(np.searchsorted(contexts, gram >> 8), len(contexts) - 1)
                known = contexts[of] == gram >> 8
                base = np.log2(total[of] + different[of])
                cost = np.where(seen, base - np.log2(c[at]),
                                np.where(known, cost + base - np.log2(different[of]), cost))
            out[:, j] = cost
        return out

    def bits(self, texts: list[str]) -> np.ndarray:
        """Code length of each text in each language."""
        codes, ends = _grams(texts)
        out = np.zeros((len(texts), len(self.langs)))
        full = np.diff(ends) > 0
        if not full.any() or not self.langs:
            return out
        at = self.slots[self._slot(codes)]
        costs = self.costs[at]
        other = np.flatnonzero(self.keys[at] != codes)
        if len(other):
            rare, where = np.unique(codes[other], return_inverse=True)
            costs[other] = self._costs(rare.astype(np.int64))[where]
        out[full] = np.add.reduceat(costs, ends[:-1][full], axis=0, dtype=np.float64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, its probability among the languages, and bits a byte; by chunks of text."""
        names, scores, rates = [], [], []
        chunk: list[str] = []
        size = 0

        def flush():
            bits = self.bits(chunk)
            n = np.array([max(1, len(t.encode("utf-8", "surrogatepass"))) for t in chunk])
            best = bits.argmin(axis=1) if self.langs else np.zeros(len(chunk), int)
            for t, b, i, m in zip(chunk, bits, best, n, strict=True):
                if self.langs and has_letter(t):
                    names.append(self.langs[i])
                    scores.append(float(1 / np.exp2(np.minimum(0, b[i] - b)).sum()))
                    rates.append(float(b[i] / m))
                else:
                    names.append("und")
                    scores.append(0.0)
                    rates.append(0.0)

        for t in texts:
            chunk.append(t or "")
            size += len(chunk[-1])
            if size > 1_000_000:
                flush()
                chunk, size = [], 0
        if chunk:
            flush()
        return names, np.array(scores), np.array(rates)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          max_nodes: int = MAX_NODES) -> ByteModel:
    """Frozen trees from all rows with text and language.

    Every row counts. Of each language's grams the max_nodes most frequent stay in the tree
    (a stated size of the model: 512 languages * 200,000 grams at most reach the driver).
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    grams = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = grams.withColumn("rank", rank).where(F.col("rank") <= max_nodes).drop("rank")
    found = top.toArrow()
    langs = np.array(found.column("lang").to_pylist(), dtype=object)
    gram, n = (found.column(c).to_numpy() for c in ("gram", "n"))
    names = set(langs.tolist())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} languages, {MAX_LANGUAGES} at most")
    counts = {}
    for name in names:
        own = langs == name
        order = np.argsort(gram[own])
        counts[name] = (gram[own][order], n[own][order])
    return ByteModel(counts)


def identify(docs: DataFrame, model: ByteModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, lang_pred, score, bits_per_byte.

    score is the language's probability given equal priors. A null or empty text, one without
    a letter, or a model without languages gives `und` and score 0. Rows stay as they are,
    repeated ones too; ties go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        frozen = ByteModel.of(shared.value)
        for ids, texts in columns_of(batches, "doc_id", "text", rows=512):
            names, scores, rates = frozen.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(rates, pa.float64())],
                ["doc_id", "lang_pred", "score", "bits_per_byte"])

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, lang_pred string, score double, bits_per_byte double")


def rate_limits(docs: DataFrame, model: ByteModel, text_col: str = "text", lang_col: str = "lang",
                quantile: float = 0.99, times: float = 2.0) -> dict[str, float]:
    """By language, `times` the quantile of bits a byte over all its training texts."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        frozen = ByteModel.of(shared.value)
        for langs, texts in columns_of(batches, "lang", "text", rows=512):
            names, _, rates = frozen.predict(texts)
            own = [i for i, (a, b) in enumerate(zip(langs, names, strict=True)) if a == b]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in own], pa.string()), pa.array(rates[own], pa.float64())], ["lang", "rate"])

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    found = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).mapInArrow(
        run, "lang string, rate double").groupBy("lang").agg(F.percentile_approx("rate", quantile).alias("rate"))
    return {r["lang"]: times * r["rate"] for r in found.collect()}


def keep_identified(docs: DataFrame, model: ByteModel, text_col: str = "text",
                    min_score: float = 0.5, limits: dict[str, float] | None = None) -> DataFrame:
    """The rows, all columns, whose text has a language with at least min_score.

    limits: bits a byte by language. A text goes that takes over SLACK_BITS more than its
    language's limit allows, so a short one isn't judged by one rare word. A model without
    languages can judge none: all texts with a letter stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    limits = limits or {}

    # Only the text goes to Python, and a truth value comes back: rows stay where they are.
    @F.arrow_udf("boolean")
    def stays(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        frozen = ByteModel.of(shared.value)
        for part in parts:
            mask: list[bool] = []
            for texts in in_slices(part):
                if not frozen.langs:
                    mask += map(has_letter, texts)
                    continue
                names, scores, rates = frozen.predict(texts)
                mask += [n != "und" and s >= min_score
                         and (n not in limits
                              or (r - limits[n]) * len(t.encode("utf-8", "surrogatepass")) <= SLACK_BITS)
                         for t, n, s, r in zip(texts, names, scores.tolist(), rates.tolist(), strict=True)]
            yield pa.array(mask, pa.bool_())

    return docs.where(stays(F.col(text_col).cast("string")))


def held_out(id_col: str = "doc_id"):
    return id_crc(id_col) % 4 == 2


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return identify(docs, model).withColumn("held_out", held_out()).select(
        "doc_id", "held_out", "lang_pred", "score", "bits_per_byte")
