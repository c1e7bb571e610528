"""LM scoring by a hashed maximum-entropy model with a class-factored softmax."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_of, head_of, id_crc, id_text, stored, table, words_of

SIDE = 16  # super-classes, and classes of each
CLASSES = SIDE * SIDE
OWN = CLASSES // 2  # classes of one frequent token each; the others are by the word's end
_HASHED_BITS = 11
HASHED = 1 << _HASHED_BITS
FEATURES = 3 * HASHED + CLASSES
HEAD_ENTRIES = 1 << 18
HEAD_BYTES = 64
BATCH = 16_384
RATE = 0.15
LIMIT = 12.0  # of a weight, so that sums of four are within exp's range
ROUNDS = 2
END = ""  # the key of the end token; no word is empty
_PART = 128
_FLUSH = 400_000
_CACHE = 1 << 20


class Codes(dict):
    """By word (bytes): class * HASHED + hash. Filled as words come."""

    def __init__(self, own: dict[bytes, int]):
        self.own = own

    def __missing__(self, word: bytes) -> int:
        k = self.own.get(word)
        if k is None:
            k = OWN + zlib.crc32(word[-3:]) % (CLASSES - OWN)
        self[word] = code = k * HASHED + zlib.crc32(word) % HASHED
        return code


def _events(docs: list[list[bytes]], codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Features (4, tokens) and classes of all tokens of the documents, ends included.

    Features: the word before, the word two before (a skip), the classes of both as a pair,
    and the class three before (a skip).
    """
    if len(codes) > _CACHE:
        codes.clear()
    start = codes[b"\0"]
    flat: list[int] = []
    for words in docs:
        flat += (start, start, start)
        flat.extend(map(codes.__getitem__, words))
        flat.append(0)
    code = np.array(flat, np.int32)
    kind, h = code >> _HASHED_BITS, code & (HASHED - 1)
    pair = (kind[2:-1] * 40_503 + kind[1:-2] * 9_973) & (HASHED - 1)
    events = np.stack([h[2:-1], HASHED + h[1:-2], 2 * HASHED + pair, 3 * HASHED + kind[:-3]])
    lengths = np.array([len(w) + 4 for w in docs])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    target = np.ones(len(code), bool)
    target[(starts[:, None] + np.arange(3)).ravel()] = False
    target = target[3:]
    return events[:, target], kind[3:][target]


class MaxEnt:
    """p(class | history) = p(super-class | history) * p(class | super-class, history), both
    softmaxes over sums of the history's feature rows."""

    def __init__(self, upper: np.ndarray | None = None, lower: np.ndarray | None = None):
        self.upper = np.zeros((FEATURES, SIDE), np.float32) if upper is None else upper
        self.lower = np.zeros((FEATURES * SIDE, SIDE), np.float32) if lower is None else lower

    def _logits(self, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
        z = weights.take(rows[0], axis=0)
        for r in rows[1:]:
            z += weights.take(r, axis=0)
        return z

    def log_probability(self, events: np.ndarray, classes: np.ndarray) -> np.ndarray:
        out = np.empty(len(classes))
        for lo in range(0, len(classes), BATCH):
            x, k = events[:, lo:lo + BATCH], classes[lo:lo + BATCH]
            n = np.arange(len(k))
            a = self._logits(self.upper, x)
            b = self._logits(self.lower, x * SIDE + k // SIDE)
            # weights stay small, so exp needs no shift
            out[lo:lo + BATCH] = a[n, k // SIDE] + b[n, k % SIDE] - np.log(
                np.exp(a).sum(axis=1) * np.exp(b).sum(axis=1))
        return out

    def step(self, events: np.ndarray, classes: np.ndarray, seen: tuple[np.ndarray, np.ndarray]) -> None:
        """One gradient step (AdaGrad by row) on a batch. Gradients are summed by row of the
        lower level first; those sums, far fewer, are summed by row of the upper level."""
        n, side = np.arange(len(classes)), classes // SIDE
        g = np.empty((len(classes), 2 * SIDE), np.float32)
        np.exp(self._logits(self.upper, events), out=g[:, :SIDE])
        np.exp(self._logits(self.lower, events * SIDE + side), out=g[:, SIDE:])
        g[:, :SIDE] /= g[:, :SIDE].sum(axis=1, keepdims=True)
        g[:, SIDE:] /= g[:, SIDE:].sum(axis=1, keepdims=True)
        g[n, side] -= 1
        g[n, SIDE + classes % SIDE] -= 1
        for j, x in enumerate(events):
            # 16-bit keys: sorted by counting
            order = np.argsort(((x - j * HASHED) * SIDE + side).astype(np.uint16), kind="stable")
            own = (x * SIDE + side)[order]
            own, total = _sums(own, g.take(order, axis=0))
            self._move(self.lower, seen[1], own, total[:, SIDE:])
            self._move(self.upper, seen[0], *_sums(own // SIDE, total[:, :SIDE]))

    @staticmethod
    def _move(weights: np.ndarray, memory: np.ndarray, rows: np.ndarray, g: np.ndarray) -> None:
        m = memory.take(rows) + np.einsum("ij,ij->i", g, g) / SIDE
        memory[rows] = m
        w = weights.take(rows, axis=0)
        w -= g * (RATE / np.sqrt(m + 1e-6))[:, None]
        weights[rows] = np.clip(w, -LIMIT, LIMIT, out=w)


def _sums(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of sorted ones, and the sums of their rows.

    Most keys have few rows, which are added column-wise in step; only longer runs are reduced
    one by one.
    """
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    length = np.diff(first, append=len(keys))
    total = rows.take(first, axis=0)
    for i in (1, 2, 3):
        at = np.flatnonzero((length > i) & (length <= 4))
        total[at] += rows.take(first[at] + i, axis=0)
    many = length > 4
    if many.any():
        ends = np.cumsum(length[many])
        total[many] = np.add.reduceat(rows[np.repeat(many, length)], np.concatenate(([0], ends[:-1])), axis=0)
    return keys[first], total


def _trained(state, own):
    """A task's pass over its documents from the shared weights; its weights by parts of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, codes = MaxEnt(*(w.copy() for w in state.value)), Codes(own.value)
        seen = (np.zeros(FEATURES, np.float32), np.zeros(FEATURES * SIDE, np.float32))
        hits = np.zeros(FEATURES)
        held: list[list[bytes]] = []
        size = 0

        def learn():
            x, k = _events(held, codes)
            for lo in range(0, len(k), BATCH):
                model.step(x[:, lo:lo + BATCH], k[lo:lo + BATCH], seen)
            hits[:] += np.bincount(x.ravel(), minlength=FEATURES)

        for (texts,) in columns_of(batches, "text"):
            for text in texts:
                held.append(words_of(text))
                size += len(held[-1]) + 1
                if size >= 4 * BATCH:
                    learn()
                    held, size = [], 0
        if held:
            learn()
        if hits.any():
            both = np.concatenate([model.upper, model.lower.reshape(FEATURES, -1)], axis=1)
            for part in range(0, FEATURES, _PART):
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()),
                    pa.array([hits[part:part + _PART].tobytes()], pa.binary()),
                    pa.array([both[part:part + _PART].astype(np.float16).tobytes()], pa.binary())],
                    ["part", "hits", "weights"])
    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows' weights averaged over tasks by how often each task met the row, as a stream."""
    hits = total = None
    part = 0
    for parts, counts, weights in columns_of(batches, "part", "hits", "weights"):
        part = parts[0]
        for c, w in zip(counts, weights, strict=True):
            n = np.frombuffer(c, np.float64)
            values = np.frombuffer(w, np.float16).reshape(len(n), -1).astype(np.float64) * n[:, None]
            hits = n if hits is None else hits + n
            total = values if total is None else total + values
    mean = (total / np.maximum(hits, 1)[:, None]).astype(np.float32)
    yield pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([hits.tobytes()], pa.binary()),
         pa.array([mean.tobytes()], pa.binary())], ["part", "hits", "weights"])


def train(texts: DataFrame, own: dict[bytes, int], rounds: int = ROUNDS) -> MaxEnt:
    """Weights after one pass over all texts (doc_id, text), dealt to `rounds` rounds by hash.

    In a round every task starts from the same weights, takes gradient steps through its
    texts, and sends its rows; the rows are averaged, weighted by how often they were met.
    The model's size is fixed (7 MB), whatever the corpus.
    """
    spark = texts.sparkSession
    model, words = MaxEnt(), spark.sparkContext.broadcast(own)
    for i in range(rounds):
        state = spark.sparkContext.broadcast((model.upper, model.lower))
        turn = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(0)), F.lit("round")), F.lit(rounds)) == i
        parts = texts.where(turn).select("text").mapInArrow(
            _trained(state, words), "part int, hits binary, weights binary").groupBy("part").applyInArrow(
            _averaged, "part int, hits binary, weights binary").collect()
        for r in parts:
            hits = np.frombuffer(r["hits"], np.float64)
            rows = np.frombuffer(r["weights"], np.float32).reshape(len(hits), -1)
            at = np.flatnonzero(hits) + r["part"]
            model.upper[at] = rows[hits > 0, :SIDE]
            model.lower.reshape(FEATURES, -1)[at] = rows[hits > 0, SIDE:]
    return model


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    ends = 0

    def flush():
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["token", "n"])
        counts.clear()
        return out

    for (texts,) in columns_of(batches, "text"):
        for text in texts:
            counts.update(words_of(text))
            ends += 1
            if len(counts) > _FLUSH:
                yield flush()
    if ends:
        counts[END.encode()] = ends
        yield flush()


def _scored(state, own, head, unknown_base: float):
    """A row of each document with what its frequent tokens and its classes add, and rows of
    its other tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, codes = MaxEnt(*state.value), Codes(own.value)
        place, base, within = head.value
        end = place.get(END.encode())
        at = TaskContext.get().partitionId() << 36
        for ids, texts in columns_of(batches, "doc_id", "text"):
            for lo in range(0, len(ids), 256):
                docs = [words_of(t) for t in texts[lo:lo + 256]]
                x, k = _events(docs, codes)
                lengths = np.array([len(d) + 1 for d in docs])
                log_p = np.add.reduceat(model.log_probability(x, k), np.concatenate(([0], np.cumsum(lengths)[:-1])))
                flat = list(chain.from_iterable(docs))
                of = np.repeat(np.arange(len(docs)), lengths - 1)
                found = np.fromiter(map(place.get, flat, repeat(-1)), np.int64, len(flat))
                frequent = found >= 0
                hit, of_hit = found[frequent], of[frequent]
                known = np.bincount(of_hit, minlength=len(docs))
                base_score = np.bincount(of_hit, base[hit], len(docs))
                score = np.bincount(of_hit, within[hit], len(docs)) + log_p / np.log(10)
                if end is not None:
                    known, base_score, score = known + 1, base_score + base[end], score + within[end]
                others = np.flatnonzero(~frequent)
                cuts = np.searchsorted(of[others], np.arange(len(docs) + 1)).tolist()
                rare = [flat[j] for j in others.tolist()]
                tokens: list[bytes] = [b"\0%d" % (at + i) for i in range(len(docs))]
                times, distinct = [0] * len(docs), []
                for i in range(len(docs)):
                    own_rare = Counter(rare[cuts[i]:cuts[i + 1]])
                    tokens.extend(own_rare)
                    times.extend(own_rare.values())
                    distinct.append(len(own_rare))
                n = len(tokens) - len(docs)
                rows = np.arange(at, at + len(docs))
                at += len(docs)
                none, nothing = np.zeros(n, np.int64), np.zeros(n)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate((rows, np.repeat(rows, distinct)))),
                    pa.array(ids[lo:lo + 256] + [None] * n, pa.int64()),
                    pa.array(np.concatenate((lengths, none))), pa.array(np.concatenate((known, none))),
                    pa.array(np.concatenate((base_score, nothing))), pa.array(np.concatenate((score, nothing))),
                    pa.array(tokens, pa.binary()).cast(pa.string()), pa.array(times, pa.int64()),
                    pa.array([0] * len(docs) + [codes[w] >> _HASHED_BITS for w in tokens[len(docs):]], pa.int32())],
                    ["row", "doc_id", "n_tokens", "known", "base", "score", "token", "times", "class"])
    return run


def score(docs: DataFrame, training: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10).

    training: which documents to learn from (default: all), a condition on id_col. Tokens are
    words (A-Z in lower case) and one end. base_score: add-one unigrams. score:
    p(class | history) of the model times (c + 1) / (N + V + 1) within the class, so that the
    tokens that training lacks share one place in each class; both sum to one.

    Frequent tokens (at most HEAD_ENTRIES of HEAD_BYTES bytes, 16 MB) are summed in the task
    that reads the document; others are joined with all training counts by token.

    Null texts count as empty: the end alone. Repeated rows stay rows of their own. Without
    training documents every token has the same chance. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    learned = docs if training is None else docs.where(training)
    vocabulary = stored(id_text(learned, id_col, text_col).select("text").mapInArrow(
        _token_counts, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")))
    size = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_all, n_distinct = size
    head = sorted(((r["token"].encode(), r["n"]) for r in head_of(vocabulary, "token", "n", HEAD_ENTRIES, HEAD_BYTES)),
                  key=lambda x: (-x[1], x[0]))
    own = {w: i + 1 for i, (w, _) in enumerate([x for x in head if x[0]][:OWN - 1])}
    n_class, v_class = np.zeros(CLASSES), np.zeros(CLASSES)
    code = F.when(F.col("token") == END, 0).otherwise(OWN + F.crc32(_last_bytes("token")) % (CLASSES - OWN))
    for r in vocabulary.groupBy(code.cast("int").alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        n_class[r["c"]], v_class[r["c"]] = r["n"], r["v"]
    for w, n in head:
        if w in own:  # out of the class of its last bytes into its own
            c = OWN + zlib.crc32(w[-3:]) % (CLASSES - OWN)
            n_class[c], v_class[c] = n_class[c] - n, v_class[c] - 1
            n_class[own[w]], v_class[own[w]] = n, 1
    # a class of one token holds no others
    total = np.where(np.arange(CLASSES) < OWN, np.maximum(n_class + v_class, 1), n_class + v_class + 1)
    model = train(id_text(learned, id_col, text_col), own)
    codes = Codes(own)
    counts = np.array([n for _, n in head], np.float64)
    of = np.array([codes[w] // HASHED if w else 0 for w, _ in head], np.int64)
    unknown = -float(np.log10(n_all + n_distinct + 1))
    shared = spark.sparkContext.broadcast((
        {w: i for i, (w, _) in enumerate(head)}, np.log10(counts + 1) + unknown,
        np.log10(counts + 1) - np.log10(total[of]) if len(head) else counts))
    parts = id_text(docs, id_col, text_col).mapInArrow(
        _scored(spark.sparkContext.broadcast((model.upper, model.lower)), spark.sparkContext.broadcast(own), shared,
                unknown),
        "row long, doc_id long, n_tokens long, known long, base double, score double, token string, times long, "
        "class int")
    within = F.element_at(F.array(*[F.lit(float(x)) for x in np.log10(total)]), F.col("class") + 1)
    c = F.log10(F.coalesce("n", F.lit(0)) + 1)
    joined = parts.join(vocabulary, "token", "left")
    return joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        F.sum(F.col("base") + F.col("times") * (c + unknown)).alias("base_score"),
        F.sum(F.col("score") + F.when(F.col("times") > 0, F.col("times") * (c - within)).otherwise(0.0))
        .alias("score")).drop("row")


def _last_bytes(token: str) -> Column:
    return F.substring(F.col(token).cast("binary"), -3, 3)


def held_out(id_col: str = "doc_id") -> Column:
    return id_crc(id_col) % 7 == 2


def op2_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, ~held_out()).withColumn("held_out", held_out()).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
