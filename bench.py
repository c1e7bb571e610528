"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all),
BENCH_RUNS (default 3, after one untimed run), BENCH_QUERIES (comma list, default below).
Each query runs in full into the noop sink; a time is the median of the runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "clean_ticks", "clean_ticks_by_part", "cleaning_report", "daily_bars",
    "daily_metrics", "daily_metrics_in_place", "daily_metrics_unique_keys",
    "daily_metrics_by_user", "daily_metrics_by_user_in_place",
    "daily_metrics_by_type", "daily_metrics_by_part", "daily_metrics_by_part_in_place",
    "calendar_metrics_by_part", "explode_history", "restrict_to_top_k", "lookback",
    "append_skip_existing", "append_skip_existing_bucketed", "append_by_day_skip_existing",
    "daily_metrics_by_part_sliced", "written_bars",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get(
        "BENCH_QUERIES") else HEADLINE

    from barloom.session import get_session
    from workload.queries import QUERIES

    spark = get_session(
        "bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        # The tables are few megabytes: cut them so that every core reads a part.
        spark__sql__files__maxPartitionBytes="1m",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="run-"))
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
