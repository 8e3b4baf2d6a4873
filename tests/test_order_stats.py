"""Exact quantiles: keys, passes and memory."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import order_stats as O


def test_sort_key_orders_as_the_value(spark):
    xs = [0.0, -0.0, 1.0, -1.0, 1.5, 2.0, math.pi, 5e-324, -5e-324, 2.2250738585072014e-308, 1e308, -1e308, 0.1, 0.2, 0.30000000000000004,
          float("inf"), float("-inf"), float("nan"), 1e-310, 123456.789, -7.25]
    xs += [random.Random(1).uniform(-1, 1) * 10.0 ** random.Random(i).randint(-300, 300) for i in range(200)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").withColumn("k", O.sort_key(F.col("x"))).collect()
    want = sorted(rows, key=lambda r: (math.isnan(r.x), r.x))
    got = sorted(rows, key=lambda r: r.k)
    assert [r.k for r in got] == [r.k for r in want]
    keys = {}
    for r in rows:
        keys.setdefault(r.k, set()).add("nan" if math.isnan(r.x) else r.x + 0.0)
    assert all(len(v) == 1 for v in keys.values())


@pytest.mark.parametrize("limit,bits", [(0, 16), (50, 16), (10, 8), (10**9, 16)])
def test_quantiles_equal_numpy(spark, limit, bits):
    rng = random.Random(7)
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.choice([rng.gauss(0, 1e6), float(rng.randint(-3, 3)), None]), rng.random()) for _ in range(900)]
    rows += [("lone", 4.5, 0.25), ("empty", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(4)
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: (r.x, r.y) for r in O.exact_quantiles(df, ["g"], {"x": "x", "y": F.col("y") * 2}, ps, limit, bits).collect()}
    assert set(got) == {"hot", "a", None, "lone", "empty"} and got["empty"] == (None, None)
    for g in ("hot", "a", None, "lone"):
        for i, scale in ((1, 1), (2, 2)):
            vals = [r[i] * scale for r in rows if r[0] == g and r[i] is not None]
            assert np.allclose(got[g][i - 1], np.quantile(vals, ps), rtol=1e-12)
    one = O.exact_medians(df, [], {"x": "x"}, limit, bits).first()
    assert math.isclose(one.x, np.median([r[1] for r in rows if r[1] is not None]), rel_tol=1e-12)
    assert O.exact_medians(df.limit(0), [], {"x": "x"}, limit, bits).first().x is None


def test_no_task_holds_more_than_a_bucket(spark):
    """All values differ: the buckets that are looked into shrink to the limit, and nothing larger is sorted."""
    n, limit = 60_000, 500
    df = spark.range(n).select(F.lit("g").alias("g"), (F.sin("id") * 1e5).alias("x"))
    long = O._long(df, ["g"], {"x": "x"})
    wanted = spark.createDataFrame([("g", 0, n // 2, n)], "g string, which int, rank bigint, n bigint")
    seen = []
    plain = O.cut_lineage

    def watched(frame, name="stage"):
        out = plain(frame, name)
        if name == "order-state":
            seen.append(out.agg(F.max("inside")).first()[0])
        return out

    O.cut_lineage = watched
    try:
        got = O.ranked_values(long, wanted, ["g"], limit).first().x
    finally:
        O.cut_lineage = plain
    assert got == sorted(math.sin(i) * 1e5 for i in range(n))[n // 2] or math.isclose(got, sorted(math.sin(i) * 1e5 for i in range(n))[n // 2], rel_tol=1e-12)
    assert seen[0] == n and seen[-1] <= limit and len(seen) <= 5
    plan = O.exact_medians(df, ["g"], {"x": "x"}, limit)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan
