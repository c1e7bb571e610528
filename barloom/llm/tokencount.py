"""Token counts: pieces counted once per distinct pre-token, joined to the documents' pre-tokens."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from pathlib import Path

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, head_of, id_text, stored, table, worker_cache

HEAD_ENTRIES = 1 << 19
HEAD_BYTES = 48
LIMIT = 2048
_FLUSH = 400_000
_CACHE = 1 << 19
# Texts of these characters only are cut by Python; any other text by the tokenizer's own parts.
_PLAIN = re.compile(r"[\t-\r\x20-\x7e¡-įı-ſ]*")
_LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ſ"
_DIGITS = "0-9²³¹¼-¾"
_PRE_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\s{_LETTERS}{_DIGITS}]+")


class PreTokens:
    """The pre-tokens of a text, as the tokenizer of a JSON definition cuts them.

    Added tokens are cut out first, each a pre-token of its own; the rest is normalised and
    split. For plain texts, lower case and white space are all that normalising changes.
    """

    def __init__(self, definition: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        parts = json.loads(definition)
        self.tokenizer = Tokenizer.from_str(definition)
        added = [re.escape(t["content"]) for t in parts["added_tokens"]]
        self.added = re.compile("(" + "|".join(added) + ")") if added else None
        split = parts["pre_tokenizer"]["pretokenizers"][0]
        self.split = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), "removed", invert=True)

    def words(self, text: str) -> tuple[list[str], list[str]]:
        """Words that are still to be cut into pre-tokens, and pre-tokens."""
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return text.lower().split(), []
        done = []
        for i, part in enumerate(self.added.split(text) if self.added else [text]):
            if i % 2:
                done.append(part)
            elif part:
                done += [t for t, _ in self.split.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(part))]
        return [], done

    @staticmethod
    def cut(word: str) -> list[str]:
        return _PRE_TOKEN.findall(word)

    def pieces(self, tokens: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(tokens, add_special_tokens=False)]


def _cutter(definition: str) -> PreTokens:
    """One for each worker."""
    held = worker_cache("pre_tokens")
    if definition not in held:
        held.clear()
        held[definition] = PreTokens(definition)
    return held[definition]


def _frequencies(definition):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, words, tokens = _cutter(definition.value), Counter(), Counter()

        def flush():
            for w, n in words.items():
                for t in cutter.cut(w):
                    tokens[t] += n
            words.clear()
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(tokens), pa.string()), pa.array(list(tokens.values()), pa.int64())], ["token", "n"])
            tokens.clear()
            return out

        for (texts,) in columns_of(batches, "text"):
            for text in texts:
                some, done = cutter.words(text)
                words.update(some)
                tokens.update(done)
                if len(words) + len(tokens) > _FLUSH:
                    yield flush()
        yield flush()
    return run


def _pieces(definition):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _cutter(definition.value)
        for tokens, counts in columns_of(batches, "token", "n"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens, pa.string()), pa.array(counts, pa.int64()),
                 pa.array(cutter.pieces(tokens), pa.int64())], ["token", "n", "pieces"])
    return run


def _per_document(definition, head):
    """A row (row, doc_id, n_bytes, head) of each document, head the pieces of its frequent
    pre-tokens, and rows (row, token, times) of its other ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, frequent = _cutter(definition.value), head.value
        at = TaskContext.get().partitionId() << 36
        known: dict[str, int] = {}

        def cost(word: str) -> int | None:
            n = 0
            for t in cutter.cut(word):
                if t not in frequent:
                    return None
                n += frequent[t]
            return n

        for ids, texts in columns_of(batches, "doc_id", "text"):
            rows, docs, sizes, heads, tokens, times = [], [], [], [], [], []
            for i, text in zip(ids, texts, strict=True):
                some, done = cutter.words(text)
                rare: Counter = Counter()
                total = 0
                for t in done:
                    if t in frequent:
                        total += frequent[t]
                    else:
                        rare[t] += 1
                new = [w for w in some if w not in known]
                if new:
                    for w, n in Counter(new).items():
                        c = cost(w)
                        if c is not None:
                            if len(known) > _CACHE:
                                known.clear()
                                known.update((x, y) for x in some if (y := cost(x)) is not None)
                            known[w] = c
                        else:
                            for t in cutter.cut(w):
                                if t in frequent:
                                    total += n * frequent[t]
                                else:
                                    rare[t] += n
                total += sum(map(known.get, some, repeat(0)))
                rows += [at] * (1 + len(rare))
                docs += [i] + [None] * len(rare)
                sizes += [len(text.encode("utf-8", "surrogatepass"))] + [None] * len(rare)
                heads += [total] + [0] * len(rare)
                tokens += [f"\0{at}", *rare]
                times += [0, *rare.values()]
                at += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(docs, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(heads, pa.int64()), pa.array(tokens, pa.string()), pa.array(times, pa.int64())],
                ["row", "doc_id", "n_bytes", "head", "token", "times"])
    return run


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    path: a tokenizer's JSON definition, read on the driver. The pieces of every distinct
    pre-token of the corpus are counted once. Those of the most frequent pre-tokens (at most
    HEAD_ENTRIES of HEAD_BYTES bytes, 24 MB) go to all tasks, which sum them at once; the
    others are joined by pre-token and summed by document. Only counts leave a task.

    Null texts count as empty: 0 bytes, 0 tokens. Repeated rows and ids stay rows of their
    own. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(Path(path).read_text())
    texts = id_text(docs, id_col, text_col)
    vocabulary = texts.select("text").mapInArrow(_frequencies(definition), "token string, n long").groupBy(
        "token").agg(F.sum("n").alias("n"))
    vocabulary = stored(vocabulary.mapInArrow(_pieces(definition), "token string, n long, pieces long"))
    head = spark.sparkContext.broadcast({
        r["token"]: r["pieces"] for r in head_of(vocabulary, "token", "n", HEAD_ENTRIES, HEAD_BYTES)})
    parts = texts.mapInArrow(
        _per_document(definition, head),
        "row long, doc_id long, n_bytes long, head long, token string, times long")
    joined = parts.join(vocabulary.select("token", "pieces"), "token", "left")
    counted = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
        F.sum(F.col("head") + F.col("times") * F.coalesce("pieces", F.lit(0))).alias("n_tokens"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
