"""Packing documents into sequences by a configuration linear program over their lengths."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, id_text, stored, table

CAPACITY = 1024
END = 2
STEP = 0.25
_CACHE = 1 << 19  # pre-tokens, some 80 MB
_NEWLINE = "\n"
# Texts of these characters only are cut by Python; any other text by the tokenizer itself.
_PLAIN = re.compile(r"[\t-\r\x20-\x7e¡-ſ]*")
_LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ſ"
_DIGITS = "0-9²³¹¼-¾"
_PRE_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+"
                        rf"| ?[^\s{_LETTERS}{_DIGITS}]+|\s+(?!\S)|\s+")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones
    for themselves, the rest in order from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Ids:
    """Ids of texts as little-endian 32-bit numbers, as `tokenizers` gives them for a byte-level
    BPE definition without added special tokens.

    Ids of a pre-token do not hang on its neighbours, so they are kept by pre-token. New ones
    are merged by tiktoken from the same vocabulary (its ids are the merges' order). A text
    with other characters or an added token's string goes through `tokenizers` as a whole.
    """

    def __init__(self, definition: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        parts = json.loads(definition)
        self.added = [t["content"] for t in parts["added_tokens"]]
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in t): i for t, i in parts["model"]["vocab"].items() if t not in self.added}
        self.encoding = tiktoken.Encoding(
            "vocabulary", pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
            mergeable_ranks=ranks, special_tokens={})
        self.newline = ranks[b"\n"]
        self.cache: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        words = [t for t in new if not t.isspace()]
        for t in new:
            if t.isspace():
                self.cache[t] = np.array(self.encoding.encode_ordinary(t), "<u4").tobytes()
        if words:
            ids = np.asarray(self.encoding.encode_to_numpy(_NEWLINE.join(words)), "<u4")
            ends = np.flatnonzero(ids == self.newline)
            for t, part in zip(words, np.split(ids, ends), strict=True):
                self.cache[t] = part[1:].tobytes() if len(part) and part[0] == self.newline else part.tobytes()

    def of(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or any(a in text for a in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        tokens = _PRE_TOKEN.findall(text)
        try:
            return b"".join(map(self.cache.__getitem__, tokens))
        except KeyError:
            if len(self.cache) > _CACHE:
                self.cache.clear()
            self._learn([t for t in dict.fromkeys(tokens) if t not in self.cache])
            return b"".join(map(self.cache.__getitem__, tokens))


def _pieces(definition, capacity: int, end: int):
    last = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # goes with the task: workers live on, and other stages need their memory
        encoder = Ids(definition.value)
        for ids, texts in columns_of(batches, "doc_id", "text", rows=512):
            out: tuple[list, ...] = ([], [], [], [], [])
            for i, t in zip(ids, texts, strict=True):
                b = encoder.of(t) + last
                n = len(b) // 4
                at, size = 0, n if n <= capacity else n % capacity or capacity
                k = 0
                while at < n:
                    for column, v in zip(out, (i, k, at, size, zlib.crc32(b[4 * at:4 * (at + size)])), strict=True):
                        column.append(v)
                    at, size, k = at + size, capacity, k + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def _priced(worth: np.ndarray, lengths: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration (index of a length: how many) of the most worth that fits: a knapsack
    by dynamic programming over the capacity."""
    best = np.zeros(capacity + 1)
    item = np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        k = fits[c]
        if k:
            v = best[c - lengths[:k]] + worth[:k]
            j = int(v.argmax())
            if v[j] > best[c]:
                best[c], item[c] = v[j], j
    found: dict[int, int] = {}
    c = capacity
    while c > 0:
        if item[c] < 0:
            c -= 1
        else:
            found[int(item[c])] = found.get(int(item[c]), 0) + 1
            c -= int(lengths[item[c]])
    return found


def configurations(lengths: np.ndarray, counts: np.ndarray, capacity: int = CAPACITY,
                   step: float = STEP) -> list[tuple[dict[int, int], int]]:
    """Configurations (length: how many) and how many sequences have each; exact for the counts.

    The covering program (least number of sequences so that each length is covered as often
    as it occurs) is solved by multiplicative weights: the weight of a length falls with the
    share of it that is covered, the knapsack finds the configuration of the most weight, and
    it is used until it adds `step` to the share of one of its lengths. The solution scaled to
    cover once is rounded down, and what is left (a few pieces of each configuration) is
    packed by best fit, longest first.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    order = np.argsort(lengths)
    lengths, left = lengths[order], counts[order].copy()
    out: list[tuple[dict[int, int], int]] = []
    if len(lengths) and lengths[-1] == capacity:
        out.append(({capacity: 1}, int(left[-1])))
        lengths, left = lengths[:-1], left[:-1]
    used: dict[tuple, float] = {}
    covered = np.zeros(len(lengths))
    if len(lengths) and left.max() > 4 / step:
        # where every length is rare, nothing would be left of the solution rounded down
        while covered.min() < 1:
            worth = np.where(covered < 1, np.exp(-covered / step), 0) * lengths / capacity
            found = _priced(worth, lengths, capacity)
            amount = step * min(left[j] / a for j, a in found.items())
            for j, a in found.items():
                covered[j] += a * amount / left[j]
            key = tuple(sorted(found.items()))
            used[key] = used.get(key, 0) + amount
    for key, amount in sorted(used.items(), key=lambda x: -sum(lengths[j] * a for j, a in x[0])):
        n = min(int(amount), *(int(left[j]) // a for j, a in key))
        if n:
            out.append(({int(lengths[j]): a for j, a in key}, n))
            for j, a in key:
                left[j] -= n * a
    return out + _best_fit(lengths, left, capacity)


def _best_fit(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Pieces by length, longest first, each into the open sequence with the least room that fits."""
    room: list[list[dict[int, int]]] = [[] for _ in range(capacity + 1)]
    for length, n in zip(lengths[::-1].tolist(), counts[::-1].tolist(), strict=True):
        for _ in range(n):
            r = next((r for r in range(length, capacity) if room[r]), None)
            one = room[r].pop() if r is not None else {}
            one[length] = one.get(length, 0) + 1
            room[(capacity if r is None else r) - length].append(one)
    same: dict[tuple, int] = {}
    for bins in room:
        for one in bins:
            key = tuple(sorted(one.items()))
            same[key] = same.get(key, 0) + 1
    return [(dict(k), n) for k, n in same.items()]


def _slots(found: list[tuple[dict[int, int], int]]) -> list[tuple[int, ...]]:
    """(length, first rank, in one sequence, first sequence, sequences, first offset) by configuration."""
    rows, rank, sequence = [], {}, 0
    for one, n in found:
        offset = 0
        for length, a in sorted(one.items(), reverse=True):
            rows.append((length, rank.get(length, 0), a, sequence, n, offset))
            rank[length] = rank.get(length, 0) + a * n
            offset += a * length
        sequence += n
    return rows


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    path: the JSON definition of a byte-level tokenizer, read on the driver. A document is its
    ids and `end`; one longer than the capacity is cut into full pieces after a shorter first
    one. The driver sees the histogram of lengths only (at most `capacity` rows) and sends
    back the slots of each length, whose number does not grow with the documents. A piece
    takes the slot of its rank among the pieces of its length. Ranks are counted within
    salted parts of a length, so that a length of a third of all pieces is spread.

    Null texts count as empty and hold `end` alone. Repeated rows are packed as often as they
    come. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(Path(path).read_text())
    pieces = stored(id_text(docs, id_col, text_col).mapInArrow(
        _pieces(definition, capacity, end),
        "doc_id long, piece int, start long, length long, ids_crc32 long"))
    salts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = parts.groupBy("length").agg(F.sum("n").alias("n")).toArrow()
    found = configurations(histogram.column("length").to_numpy(), histogram.column("n").to_numpy(), capacity)
    # from Arrow, as rows of Python objects would start a second set of Python workers
    names = ["length", "first", "each", "sequence", "sequences", "at"]
    columns = np.array(_slots(found), np.int64).reshape(-1, len(names)).T
    slots = F.broadcast(spark.createDataFrame(pa.table([pa.array(c) for c in columns], names)))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("own", F.row_number().over(own) - 1).join(
        parts.drop("n"), ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own"))
    placed = ranked.join(slots, (ranked["length"] == slots["length"]) & (F.col("rank") >= F.col("first"))
                         & (F.col("rank") < F.col("first") + F.col("each") * F.col("sequences"))
                         ).drop(slots["length"])
    nth = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("each"))).alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * F.col("length")).alias("offset"))


def op8_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
