"""Price ticks to daily bars and metrics, as Spark DataFrame functions."""

from barloom.functions.time import utc_datetime
from barloom.operators.bars import bar_counts, daily_bars, with_calendar
from barloom.operators.cleaning import (
    clean_ticks,
    cleaning_report,
    dedup_ticks,
    drop_incomplete,
    positive_price,
    valid_ticks,
)
from barloom.operators.combine import union_ticks
from barloom.operators.history import explode_history, explode_long_history, history_points, rejected_documents
from barloom.operators.metrics import (
    add_metrics,
    lagged_closes,
    moving_averages,
    price_changes,
    volatility,
)
from barloom.operators.selection import (
    FULL_PROFILE,
    SMALL_PROFILE,
    lookback,
    lookup,
    restrict_to,
    restrict_to_top_k,
    series_ids,
    top_k,
)
from barloom.operators.validation import validate_ticks
from barloom.plans.ingest import ingest, ticks_of_top_k
from barloom.plans.load import load_snapshot
from barloom.plans.report import RunReport
from barloom.plans.transform import (
    clean_bars,
    daily_metrics,
    densest_bar,
    preview,
    raw_preview,
    run_transform,
)
from barloom.session import get_session
from barloom.sinks.datasets import read_bars, write_bars, write_ticks
from barloom.sinks.tables import (
    append_ticks,
    append_ticks_jdbc,
    create_tick_table,
    without_existing,
)
from barloom.sources.documents import read_history, read_listing
from barloom.sources.snapshots import read_legacy_ticks, read_ticks, snapshot_dates

__all__ = [name for name in dir() if not name.startswith("_")]
