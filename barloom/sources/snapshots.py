"""Dated snapshots of ticks.

Current layout: `<root>/ingest_date=YYYY-MM-DD/` (optionally split further by
`crypto_id=`). Older layout: `<root>/YYYY-MM-DD/` with one combined file, or one
file per series.

A snapshot is found by its marks (see `barloom.sinks.marks`) and the folder names under the
root, from the newest date back to the first whole one. Only the files of the dates tried are
listed, and only the chosen one is opened.
"""

from __future__ import annotations

import datetime
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.time import FIRST_MS, LAST_MS, utc_datetime
from barloom.schema import TICKS
from barloom.sinks.marks import files_of, marks, whole

PARTITION = "ingest_date"

# Names in the older layout.
COMBINED_FILE = "all_cryptos_prices.parquet"
SERIES_FILES = "*.parquet"
DATE_FOLDERS = "20"
# Fixed value: what a committed write of another program leaves in its folder.
FINISHED = "_SUCCESS"

# Columns of older files that are read.
STORED = [c for c in TICKS.names if c != "datetime"]
NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"
# Footers read at a time where the files of a snapshot disagree.
FOOTERS_AT_ONCE = 16


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def _folders(spark: SparkSession, root: str) -> list[str]:
    p, fs = _hadoop_path(spark, root)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def is_date(text: str) -> bool:
    """Whether a text is a date as the folders carry it, YYYY-MM-DD."""
    try:
        return datetime.date.fromisoformat(text).isoformat() == text
    except ValueError:
        return False


def layout_of(spark: SparkSession, folder: str) -> set[str]:
    """How a snapshot folder is laid out: "series" below it, "plain" files in it, or neither."""
    files = files_of(spark, folder) or []
    return ({"series"} if any("/" in f for f in files) else set()) | (
        {"plain"} if any("/" not in f for f in files) else set())


def finished(spark: SparkSession, root: str, date: str, known: dict | None = None) -> bool:
    """Whether the snapshot of a date is whole.

    With marks, its files are those of one of them: a write cut off between two series is
    seen. A folder without marks, written by another program, is whole if its write was committed.
    `known` are the marks of the root, if they are at hand.
    """
    partition = f"{PARTITION}={date}"
    mine = (marks(spark, root) if known is None else known).get(partition)
    if mine:
        return whole(spark, root, partition, mine)
    return _exists(spark, f"{root}/{partition}/{FINISHED}")


def _dates(spark: SparkSession, root: str) -> list[str]:
    prefix = f"{PARTITION}="
    return [n[len(prefix):] for n in _folders(spark, root) if n.startswith(prefix) and is_date(n[len(prefix):])]


def snapshot_dates(spark: SparkSession, root: str) -> list[str]:
    """Dates of the finished snapshots under `root`, oldest first.

    Folders that carry no date, or whose write was not finished, are passed over.
    """
    known = marks(spark, root)
    return [d for d in _dates(spark, root) if finished(spark, root, d, known)]


def latest_date(spark: SparkSession, root: str) -> str | None:
    """The newest date with a finished snapshot; older ones are not looked at."""
    known = marks(spark, root)
    return next((d for d in reversed(_dates(spark, root)) if finished(spark, root, d, known)), None)


def _check_mode(on_empty: str) -> None:
    if on_empty not in ("error", "empty"):
        raise ValueError(f"on_empty is 'error' or 'empty', not {on_empty!r}")


def _nothing(spark: SparkSession, where: str, on_empty: str) -> DataFrame:
    if on_empty == "error":
        raise FileNotFoundError(f"no snapshot in {where}")
    return spark.createDataFrame([], TICKS)


def read_ticks(spark: SparkSession, root: str, date: str | None = None,
               on_empty: str = "error") -> DataFrame:
    """The snapshot of `date`, or the latest one.

    `on_empty` says what a missing snapshot is: an error, or a frame without rows. A
    snapshot asked for by date that was not written to its end is always an error.
    """
    _check_mode(on_empty)
    asked = date
    if date is None:
        date = latest_date(spark, root)
        if date is None:
            return _nothing(spark, root, on_empty)
    folder = f"{root}/{PARTITION}={date}"
    if asked is not None:
        if not _exists(spark, folder):
            return _nothing(spark, folder, on_empty)
        if not finished(spark, root, date):
            raise ValueError(f"the snapshot {folder} is not finished")
    # Based on the folder itself, so that its date is no column, while a
    # `crypto_id=` level below it is one, typed by the schema.
    ticks = spark.read.schema(TICKS).option("basePath", folder).parquet(folder)
    return ticks.select(TICKS.names)


def _schemas(spark: SparkSession, files: list[str]) -> dict[str, T.StructType]:
    """The schema of each file by its footer.

    One job reads all footers where the files agree, as a rule. Else each file's footer is
    read by itself, some at a time. Instants in nanoseconds, which Spark has no type for, pass
    for integers meanwhile.
    """
    before = spark.conf.get(NANOS_AS_LONG, "false")
    spark.conf.set(NANOS_AS_LONG, "true")
    try:
        try:
            merged = spark.read.option("mergeSchema", True).parquet(*files).schema
            return dict.fromkeys(files, merged)
        except Exception as e:
            if "CANNOT_MERGE_SCHEMAS" not in str(e):
                raise
        with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
            return dict(zip(files, pool.map(lambda f: spark.read.parquet(f).schema, files), strict=True))
    finally:
        spark.conf.set(NANOS_AS_LONG, before)


def _read_as_stored(spark: SparkSession, files: list[str]) -> DataFrame:
    """Ticks of files that may hold the columns in other types, or lack some.

    Files of one schema are read together, by their own types, and cast; a value that does
    not fit is null, as is a missing column.
    """
    groups: dict[tuple, list[str]] = {}
    for file, schema in _schemas(spark, files).items():
        have = {f.name: f.dataType for f in schema.fields}
        groups.setdefault(tuple(have.get(c) for c in STORED), []).append(file)

    def column(name: str, kind: T.DataType | None):
        want = TICKS[name].dataType
        if kind is None:
            return F.lit(None).cast(want).alias(name)
        return F.col(name).try_cast(want).alias(name) if kind != want else F.col(name)

    frames = []
    for kinds, members in groups.items():
        schema = T.StructType([T.StructField(c, k) for c, k in zip(STORED, kinds, strict=True) if k is not None])
        frames.append(spark.read.schema(schema).parquet(*members).select(
            *[column(c, k) for c, k in zip(STORED, kinds, strict=True)]))
    return reduce(DataFrame.unionByName, frames)


def read_legacy_ticks(spark: SparkSession, root: str, date: str | None = None,
                      on_empty: str = "error") -> DataFrame:
    """As `read_ticks`, for the older layout.

    The combined file if there is one, else the files of all series, never both.
    Older files hold what their writer inferred: prices as integers where all are whole, a
    column without values in any type, fewer columns. Each is read by its own schema.
    They may hold `datetime` in nanoseconds, which Spark does not read, and in
    the local time of the machine that wrote them; it is derived anew from `timestamp`.
    """
    _check_mode(on_empty)
    if date is None:
        dates = [n for n in _folders(spark, root) if n.startswith(DATE_FOLDERS)]
        if not dates:
            return _nothing(spark, root, on_empty)
        date = dates[-1]
    folder = f"{root}/{date}"
    combined = f"{folder}/{COMBINED_FILE}"
    if _exists(spark, combined):
        files = [combined]
    else:
        p, fs = _hadoop_path(spark, f"{folder}/{SERIES_FILES}")
        files = [str(s.getPath()) for s in fs.globStatus(p) or []]
        if not files:
            return _nothing(spark, folder, on_empty)
    ticks = _read_as_stored(spark, files)
    return ticks.withColumn("datetime", utc_datetime(F.when(F.col("timestamp").between(FIRST_MS, LAST_MS), F.col("timestamp")))).select(TICKS.names)
