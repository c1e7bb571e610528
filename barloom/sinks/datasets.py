"""Parquet datasets of ticks and bars.

Both writers return the number of rows written (bars also the ticks behind them). The
counts are observed in the stage that writes, whose tasks Spark counts once each, also
when some run again after a lost executor.

Both replace their date when the job is committed: until then, and if the job fails, an
earlier write of that date stays readable. A finished write is marked (see `marks`).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from barloom.schema import BARS, TICKS, conform
from barloom.sinks.marks import empty, mark, replace
from barloom.sources.snapshots import PARTITION, is_date, layout_of

RUN_PARTITION = "run_date"
BLOOM = {"parquet.bloom.filter.enabled#crypto_id": "true"}


# Ways to cluster the files of a snapshot.
CLUSTERED = (False, True, "both")


def _two_ways(ticks: DataFrame, files: int | None) -> DataFrame:
    """Ticks ranged by (stretch of time, crypto_id, timestamp) into about `files` files.

    There are about as many stretches as files in one of them, with like numbers of ticks: a
    lookup by time opens the files of a stretch or two, one by series a file or two of
    each stretch. The ends of the stretches come from a quantile sketch of the timestamps,
    one number a stretch. Copies of a tick are dealt like other rows.
    """
    files = files or int(ticks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretches = max(1, math.isqrt(files))
    cuts = [i / stretches for i in range(1, stretches)]
    ends = ticks.agg(F.percentile_approx("timestamp", cuts, 100 * stretches)).first()[0] if cuts else []
    stretch = F.lit(0)
    for end in ends or []:
        stretch = stretch + (F.col("timestamp") > end).cast("int")
    placed = ticks.withColumn("_stretch", F.coalesce(stretch, F.lit(0))).withColumn("_copy", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(files, "_stretch", "crypto_id", "timestamp", "_copy")
    return ranged.sortWithinPartitions("_stretch", "crypto_id", "timestamp").drop("_stretch", "_copy")


def write_ticks(ticks: DataFrame, root: str, ingest_date: str, by_series: bool = False,
                clustered: bool | str = False, files: int | None = None) -> tuple[str, int]:
    """Write the snapshot of `ingest_date`; returns (path, rows).

    By default the snapshot is replaced as a whole. `by_series` splits it by series
    and replaces only the series at hand; use it for few series. It refuses a folder that
    holds a plain snapshot. `clustered` sorts the
    files by (crypto_id, timestamp), so that Parquet statistics serve lookups by series
    and time. The range covers both columns, so a large series spreads over many files.
    `clustered="both"` serves lookups by time alone as well (see `_two_ways`), at the price of
    a pass for the quantiles; about `files` files, by default one a shuffle partition. Clustered
    files have a bloom filter on crypto_id.
    """
    if clustered not in CLUSTERED:
        raise ValueError(f"clustered is one of {CLUSTERED}, not {clustered!r}")
    if by_series and clustered:
        raise ValueError("choose one of by_series and clustered")
    path = _place(ticks, root, ingest_date, by_series)
    out = conform(ticks, TICKS)
    if clustered == "both":
        out = _two_ways(out, files)
    elif clustered:
        out = out.repartitionByRange("crypto_id", "timestamp").sortWithinPartitions(
            "crypto_id", "timestamp")
    if by_series:
        # Adaptive execution splits a large series over tasks and joins small ones.
        out = out.hint("rebalance", "crypto_id")
    seen = Observation()
    dated = out.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn(PARTITION, F.lit(ingest_date))
    replace(dated, root, PARTITION, ("crypto_id",) if by_series else (), BLOOM if clustered else {})
    rows = seen.get["rows"]
    if not rows and not by_series:
        empty(out, root, PARTITION, ingest_date)
    mark(ticks.sparkSession, root, f"{PARTITION}={ingest_date}")
    return path, rows


def _place(ticks: DataFrame, root: str, ingest_date: str, by_series: bool) -> str:
    """The folder of a snapshot, if it can be written like that."""
    if not is_date(ingest_date):
        raise ValueError(f"ingest_date is YYYY-MM-DD, not {ingest_date!r}")
    path = f"{root}/{PARTITION}={ingest_date}"
    if by_series and "plain" in layout_of(ticks.sparkSession, path):
        # Files above the series' folders would stay on disk and never be read.
        raise ValueError(f"{path} is a snapshot that is not split by series; replace it as a whole")
    return path


# What a judged row is, and the ending of the partition that takes it; None is written nowhere.
KINDS = {"good": "", "refused": "-refused", "unsound": "-unsound", "before": None}


def write_judged(rows: DataFrame, root: str, ingest_date: str, by_series: bool = False) -> tuple[dict[str, str], dict[str, int]]:
    """Write ticks with a `kind` (see KINDS) and a `reason` in one action; returns (paths, rows) by kind.

    Good ticks are the snapshot of `ingest_date`. The others go to partitions of their own
    beside it, which carry no date and so are no snapshots. All are replaced by the commit of
    one job, and counted in the stage that writes them. Snapshot files have the (null) reasons too.
    """
    _place(rows, root, ingest_date, by_series)
    out = rows.hint("rebalance", "crypto_id") if by_series else rows
    seen = Observation()
    counted = out.observe(seen, *[F.count_if(F.col("kind") == k).alias(k) for k in KINDS])
    written = {k: f"{PARTITION}={ingest_date}{end}" for k, end in KINDS.items() if end is not None}
    ending = F.coalesce(*[F.when(F.col("kind") == k, F.lit(end)) for k, end in KINDS.items() if end is not None])
    dated = counted.filter(F.col("kind").isin(*written)).withColumn(PARTITION, F.concat(F.lit(ingest_date), ending))
    replace(dated.drop("kind"), root, PARTITION, ("crypto_id",) if by_series else ())
    counts = dict(seen.get)
    for kind, partition in written.items():
        if not counts[kind] and not (by_series and kind == "good"):
            empty(rows.drop("kind"), root, PARTITION, partition.split("=", 1)[1])
        mark(rows.sparkSession, root, partition)
    return {k: f"{root}/{p}" for k, p in written.items()}, counts


def write_bars(bars: DataFrame, root: str, run_date: str,
               ordered: bool = False) -> tuple[str, int, int]:
    """Write the bars of a run, replacing an earlier one; returns (path, bars, ticks).

    Metrics arrive with each series whole and sorted by date, and are written like that.
    `ordered` sorts the dataset as a whole by (crypto_id, date) instead. It costs a
    shuffle of the bars (not of the ticks), and a second pass over them for its ranges.
    """
    if not is_date(run_date):
        raise ValueError(f"run_date is YYYY-MM-DD, not {run_date!r}")
    path = f"{root}/{RUN_PARTITION}={run_date}"
    out = bars
    if ordered:
        out = out.repartitionByRange("crypto_id", "date").sortWithinPartitions("crypto_id", "date")
    seen = Observation()
    out = out.observe(
        seen,
        F.count(F.lit(1)).alias("bars"),
        F.coalesce(F.sum("data_points"), F.lit(0)).alias("ticks"),
    )
    replace(out.withColumn(RUN_PARTITION, F.lit(run_date)), root, RUN_PARTITION)
    counts = seen.get
    if not counts["bars"]:
        empty(bars, root, RUN_PARTITION, run_date)
    mark(bars.sparkSession, root, f"{RUN_PARTITION}={run_date}")
    return path, counts["bars"], counts["ticks"]


def read_bars(spark, root: str, run_date: str, schema=BARS) -> DataFrame:
    """Read back what `write_bars` wrote."""
    return spark.read.schema(schema).parquet(f"{root}/{RUN_PARTITION}={run_date}")
