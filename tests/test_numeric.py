from __future__ import annotations

from barloom.functions.numeric import pct_change


def test_pct_change(spark):
    df = spark.createDataFrame([(3.0, 2.0), (1.0, 0.0), (1.0, None), (None, 1.0), (1.0, 3.0)],
                               "now double, before double")
    got = [r[0] for r in df.selectExpr(pct_change("now", "before")).collect()]
    assert got == [50.0, None, None, None, -66.67]
