"""Marks: which files a dated partition consists of once its write is over.

Marks are JSON rows in `<root>_finished`, appended after the write's commit. A partition is
whole if one of its marks names just the files that are there. A replacement that fails
leaves files and mark as they were; one that is cut off while its files are moved leaves
files that no mark names.
"""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "partition string, files bigint, series bigint, listing string"


def marks_of(root: str) -> str:
    return f"{root.rstrip('/')}_finished"


def files_of(spark: SparkSession, folder: str) -> list[str] | None:
    """The data files of a partition, relative to it; None if there is no such folder."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).inputFiles()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # The folder's own name occurs last where the relative part begins.
    name = folder.rstrip("/").rsplit("/", 1)[-1] + "/"
    return sorted(unquote(f).rpartition(name)[2] for f in found)


def _listing(files: list[str]) -> tuple[int, int, str]:
    """Number of files, of folders below the partition, and a hash of all names."""
    series = {f.rpartition("/")[0] for f in files} - {""}
    return len(files), len(series), hashlib.sha256("\n".join(files).encode()).hexdigest()


def mark(spark: SparkSession, root: str, partition: str) -> None:
    """Note that a partition is whole as it stands."""
    files, series, listing = _listing(files_of(spark, f"{root}/{partition}") or [])
    spark.range(1, numPartitions=1).select(
        F.lit(partition).alias("partition"), F.lit(files).cast("long").alias("files"),
        F.lit(series).cast("long").alias("series"), F.lit(listing).alias("listing"),
    ).write.mode("append").json(marks_of(root))


def marks(spark: SparkSession, root: str) -> dict[str, set[tuple[int, int, str]]]:
    """All marks below a root, by partition: a row a write."""
    try:
        rows = spark.read.schema(MARK).json(marks_of(root)).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    out: dict[str, set[tuple[int, int, str]]] = {}
    for r in rows:
        out.setdefault(r["partition"], set()).add((r["files"], r["series"], r["listing"]))
    return out


def whole(spark: SparkSession, root: str, partition: str, known: set[tuple[int, int, str]]) -> bool:
    """Whether a partition consists of just the files that one of its marks names."""
    files = files_of(spark, f"{root}/{partition}")
    return files is not None and _listing(files) in known


def replace(out: DataFrame, root: str, column: str, by: tuple[str, ...] = (), options: dict[str, str] | None = None) -> None:
    """Replace the partitions by `column` that `out` holds, or their parts by `by`.

    The files are written aside and take the place of the old ones when the job is
    committed: a job that fails leaves the old ones alone. Needs a committer that can stage
    partitions, as Spark's own for file systems does.
    """
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
        .options(**options or {}).partitionBy(column, *by).parquet(root)
    )


def empty(schema: DataFrame, root: str, column: str, value: str) -> None:
    """Replace a partition by one without rows; only for writes that turned out to have none."""
    schema.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{root}/{column}={value}")
