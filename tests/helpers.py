"""Literal frames, a brute-force model, and plan inspection."""

from __future__ import annotations

import datetime as dt
import re
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from statistics import stdev

from barloom.functions.time import MS_PER_DAY, utc_datetime
from barloom.schema import TICKS

DAY0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC
EPOCH = dt.date(1970, 1, 1)


def ticks(spark, rows):
    """Rows of (crypto_id, timestamp, price[, volume[, market_cap]])."""
    full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
    df = spark.createDataFrame(
        full, "crypto_id string, timestamp bigint, price double, volume double, market_cap double")
    return df.withColumn("datetime", utc_datetime("timestamp")).select(TICKS.names)


def closes(spark, values, crypto_id="a", start=DAY0, days=None):
    """One bar a day with these closes (on the given day numbers)."""
    days = range(len(values)) if days is None else days
    rows = [(crypto_id, EPOCH + dt.timedelta(days=start // MS_PER_DAY + d), v)
            for d, v in zip(days, values)]
    return spark.createDataFrame(rows, "crypto_id string, date date, close double")


def by_day(df, *names):
    return [tuple(r[n] for n in names) for r in df.orderBy("crypto_id", "date").collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(df, node: str) -> int:
    return len(re.findall(rf"^[ :+\-*()\d]*{node}\b", plan(df), flags=re.M))


def scan_rows(df, column: str) -> int:
    """Rows that the scans of files with this column put out while `df` was collected."""
    df.collect()
    found = 0

    def walk(node):
        nonlocal found
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.finalPhysicalPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name.startswith("ReusedExchange"):
            return None
        if name.startswith("Scan parquet") and f"{column}#" in node.toString():
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        return None

    walk(df._jdf.queryExecution().executedPlan())
    return found


def half_up(x, digits):
    if x is None:
        return None
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def _low(x):
    return float("-inf") if x is None else x


def model_metrics(rows, calendar=False):
    """Daily metrics of literal tick rows, row by row."""
    best = {}
    for cid, ts, price, volume, cap in rows:
        if cid is None or ts is None or price is None or price != price or price <= 0:
            continue
        key, rank = (cid, ts), (price, _low(volume), _low(cap))
        if key not in best or rank > best[key][0]:
            best[key] = (rank, price, volume, cap)
    days = defaultdict(list)
    for (cid, ts), (_, price, volume, cap) in best.items():
        days[cid, ts // MS_PER_DAY].append((ts, price, volume, cap))
    bars = defaultdict(dict)
    for (cid, day), points in days.items():
        points.sort()
        prices = [p[1] for p in points]
        volumes = [p[2] for p in points if p[2] is not None]
        caps = [p[3] for p in points if p[3] is not None]
        bars[cid][day] = (
            prices[0], max(prices), min(prices), prices[-1],
            float(sum(volumes)) if volumes else None,
            half_up(sum(caps) / len(caps), 0) if caps else None, len(points))
    out = []
    for cid, series in bars.items():
        order = sorted(series)
        for i, day in enumerate(order):
            def window(n):
                chosen = ([d for d in order if day - n < d <= day] if calendar
                          else order[max(0, i - n + 1): i + 1])
                return [series[d][3] for d in chosen]

            def change(n):
                if calendar:
                    before = series.get(day - n)
                else:
                    before = series[order[i - n]] if i >= n else None
                if before is None:
                    return None
                return half_up((series[day][3] - before[3]) / before[3] * 100, 2)

            w7, w30 = window(7), window(30)
            out.append((cid, EPOCH + dt.timedelta(days=day), *series[day],
                        half_up(sum(w7) / len(w7), 2), half_up(sum(w30) / len(w30), 2),
                        change(1), change(7),
                        half_up(stdev(w7), 2) if len(w7) > 1 else None))
    return sorted(out)
