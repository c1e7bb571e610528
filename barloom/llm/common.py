"""What the operators share: tables, intermediate results, batches, caches of a worker."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters that separate words, for Java's and DuckDB's regular expressions.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, or a temporary one in a local session without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that most operators read, so that no other name can clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def id_crc(id_col: str = "doc_id"):
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def columns_of(batches: Iterator[pa.RecordBatch], *names: str, rows: int | None = None) -> Iterator[tuple[list, ...]]:
    """The columns' values of each batch; `rows` rows at a time, as a batch of texts takes several
    times its size as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows or max(1, batch.num_rows)):
            part = batch.slice(at, rows)
            yield tuple(part.column(part.schema.get_field_index(n)).to_pylist() for n in names)


def in_slices(column: pa.Array, rows: int = 512) -> Iterator[list]:
    """The values of a batch's column, a slice at a time."""
    for at in range(0, len(column), rows):
        yield column.slice(at, rows).to_pylist()


def words_of(text: str) -> list[bytes]:
    """Runs of other characters than space and \\t..\\r, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, over its tasks."""
    home = sys.modules.setdefault("barloom_worker", types.ModuleType("barloom_worker"))
    return home.__dict__.setdefault(name, {})


def head_of(vocabulary: DataFrame, key: str, count: str, entries: int, max_bytes: int) -> list:
    """The most frequent rows, at most `entries`, with keys of at most `max_bytes` bytes.

    The least frequency comes from a histogram in steps of an eighth of a power of two, so
    nothing is sorted. Bounded by entries * max_bytes whatever the corpus.
    """
    short = vocabulary.where(F.octet_length(key) <= max_bytes)
    step = F.floor(F.log2(F.col(count)) * 8).cast("int")
    total, least = 0, None
    for row in short.groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect():
        total += row["count"]
        if total > entries:
            break
        least = row["s"]
    if least is None:
        return []
    return short.where(step >= least).collect()
