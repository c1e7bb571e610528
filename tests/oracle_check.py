"""Compare every query with its SQL: `python tests/oracle_check.py [sf_dir] [query ...]`."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, query, sql) -> str | None:
    """None if columns and rows are equal (doubles bit by bit), else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        more, less = got - want, want - got
        return (f"{sum(got.values())} rows, want {sum(want.values())}; "
                f"{sum(more.values())} not wanted, e.g. {list(more)[:2]}; "
                f"{sum(less.values())} missing, e.g. {list(less)[:2]}")
    return None


if __name__ == "__main__":
    from conftest import local_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = local_session(), connect(sf)
    sqls, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf, query, sqls[name]) if name in sqls else "no SQL"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}",
              flush=True)
    print("differing:", bad)
    spark.stop()
