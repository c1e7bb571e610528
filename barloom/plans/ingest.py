"""Landed documents to a snapshot of ticks."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.time import MS_PER_DAY
from barloom.operators.history import explode_history, explode_with_rejects
from barloom.operators.selection import FULL_PROFILE, lookback, restrict_to_top_k
from barloom.operators.validation import contract_breach
from barloom.plans.report import RunReport
from barloom.sinks.datasets import write_judged
from barloom.sinks.marks import files_of
from barloom.sources.snapshots import is_date


def ticks_of_top_k(listing: DataFrame, histories: DataFrame, k: int = FULL_PROFILE[0],
                   days: int | None = None, until_ms: int | None = None) -> DataFrame:
    """Ticks of the `k` largest series.

    The documents are restricted before they are exploded, so the join sees documents
    and not ticks. `days` also cuts the history; documents commonly cover it already. With
    `until_ms` the documents are read once, without it a second time for the latest tick.
    """
    ticks = explode_history(restrict_to_top_k(histories, listing, k, on="id"))
    return ticks if days is None else lookback(ticks, days, until_ms)


def end_of(date: str) -> int:
    """The last millisecond of a UTC day."""
    day = datetime.date.fromisoformat(date) - datetime.date(1970, 1, 1)
    return (day.days + 1) * MS_PER_DAY - 1


def judged_ticks(listing: DataFrame, histories: DataFrame, k: int, until: int, days: int | None = None) -> DataFrame:
    """All ticks of the `k` largest series with their `kind` and `reason`, and a row of each unsound document.

    "unsound" documents, "refused" ticks that the tick table does not take or that are later
    than `until`, ticks "before" the look-back of `days`, and "good" ones. Listing and
    documents are read once.
    """
    read = explode_with_rejects(restrict_to_top_k(histories, listing, k, on="id"))
    late = F.when(F.col("timestamp") > until, "timestamp is later than the ingest")
    reason = F.coalesce("problem", contract_breach(), late)
    before = F.lit(False) if days is None else F.col("timestamp") <= until - days * MS_PER_DAY
    kind = (F.when(F.col("problem").isNotNull(), "unsound").when(F.col("reason").isNotNull(), "refused")
            .when(before, "before").otherwise("good"))
    return read.withColumn("reason", reason).withColumn("kind", kind).drop("problem")


def ingest(listing: DataFrame, histories: DataFrame, raw_root: str, ingest_date: str,
           k: int = FULL_PROFILE[0], days: int | None = None, until_ms: int | None = None,
           by_series: bool = False) -> RunReport:
    """Write the snapshot of `ingest_date`, and what was left out of it, in one pass.

    `days` looks back from `until_ms`, by default the end of `ingest_date`; a later tick is
    refused. Refused ticks and unsound documents go, with their reasons, to partitions
    beside the snapshot's (see `write_judged`). Counts: `ticks` written,
    `documents_rejected`, `ticks_refused`, `ticks_before` the look-back; the ticks add up to
    `ticks_read`.
    """
    if not is_date(ingest_date):
        raise ValueError(f"ingest_date is YYYY-MM-DD, not {ingest_date!r}")
    until = end_of(ingest_date) if until_ms is None else until_ms
    paths, n = write_judged(judged_ticks(listing, histories, k, until, days), raw_root, ingest_date, by_series)
    files = files_of(listing.sparkSession, paths["good"]) or []
    return RunReport({"ticks": paths["good"], "refused": paths["refused"], "unsound": paths["unsound"]}, {
        "ticks": n["good"], "documents_rejected": n["unsound"], "ticks_refused": n["refused"],
        "ticks_before": n["before"], "ticks_read": n["good"] + n["refused"] + n["before"]},
        [f"{paths['good']}/{f}" for f in files])
