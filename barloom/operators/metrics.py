"""Per-series metrics over daily bars.

Each function takes `calendar`: False counts bars (a window of 7 is 7 bars), True
counts days (a window of 7 is 7 calendar days, gaps included). All windows share one
partitioning and order, and `add_metrics` asks for all of them at once, so they plan as
one shuffle, one sort and one Window node.

A series has at most one bar a day, hence a window partition is bounded by the
calendar (about 36,500 rows a century) and not by the number of ticks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.numeric import pct_change

# Rounded once the window has them.
_ROUNDED = ("ma_7d", "ma_30d", "volatility_7d")
_LAGGED = ("prev_close", "close_7d_ago")


def _series(calendar: bool) -> WindowSpec:
    order = F.unix_date("date") if calendar else F.col("date")
    return Window.partitionBy("crypto_id").orderBy(order)


def _trailing(n: int, calendar: bool) -> WindowSpec:
    w = _series(calendar)
    return w.rangeBetween(1 - n, 0) if calendar else w.rowsBetween(1 - n, 0)


def _close_before(n: int, calendar: bool) -> Column:
    """The close `n` bars (or days) ago; null if there is none."""
    if calendar:
        return F.max("close").over(_series(True).rangeBetween(-n, -n))
    return F.lag("close", n).over(_series(False))


def _averages(calendar: bool) -> dict[str, Column]:
    return {f"ma_{n}d": F.avg("close").over(_trailing(n, calendar)) for n in (7, 30)}


def _lags(calendar: bool) -> dict[str, Column]:
    return {name: _close_before(n, calendar) for name, n in zip(_LAGGED, (1, 7))}


def _spread(calendar: bool) -> dict[str, Column]:
    return {"volatility_7d": F.stddev_samp("close").over(_trailing(7, calendar))}


def _changes() -> dict[str, Column]:
    return {
        "change_1d_pct": F.expr(pct_change("close", "prev_close")),
        "change_7d_pct": F.expr(pct_change("close", "close_7d_ago")),
    }


def _rounded(windowed: DataFrame) -> DataFrame:
    names = [c for c in _ROUNDED if c in windowed.columns]
    return windowed.withColumns({c: F.round(c, 2) for c in names})


def moving_averages(bars: DataFrame, calendar: bool = False) -> DataFrame:
    """Add `ma_7d`, `ma_30d`: mean close, shorter windows at the start of a series."""
    return _rounded(bars.withColumns(_averages(calendar)))


def lagged_closes(bars: DataFrame, calendar: bool = False) -> DataFrame:
    """Add `prev_close` and `close_7d_ago`."""
    return bars.withColumns(_lags(calendar))


def price_changes(bars: DataFrame, calendar: bool = False) -> DataFrame:
    """Add `change_1d_pct` and `change_7d_pct`; null without an earlier close."""
    return lagged_closes(bars, calendar).withColumns(_changes()).drop(*_LAGGED)


def volatility(bars: DataFrame, calendar: bool = False) -> DataFrame:
    """Add `volatility_7d`: sample standard deviation of the close; null on a single bar."""
    return _rounded(bars.withColumns(_spread(calendar)))


def add_metrics(bars: DataFrame, calendar: bool = False) -> DataFrame:
    """Add the columns of `moving_averages`, `price_changes` and `volatility`."""
    averages, spread = _averages(calendar), _spread(calendar)
    windowed = bars.withColumns({**averages, **_lags(calendar), **spread})
    rounded = {c: F.round(c, 2).alias(c) for c in _ROUNDED}
    changes = [c.alias(name) for name, c in _changes().items()]
    return windowed.select(
        *bars.columns, *[rounded[c] for c in averages], *changes, *[rounded[c] for c in spread])
