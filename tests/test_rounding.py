"""Rounding equals Python's on doubles."""

import math
import random

from pyspark.sql import functions as F

from tessera.functions.rounding import py_round


def test_rounds_as_python(spark):  # MTH2
    rng = random.Random(2)
    xs = [0.0, -0.0, 0.125, 0.375, 2.5, 3.5, 0.5, 1.5, -0.125, 0.175, 0.425, 2.675, 1.005, -2.675, 1e-9, 5e-324, 1e11 + 0.5, 2.0 ** 50, 1e300,
          0.285, 1.115, 4.35, 0.049999999999999996, 0.995, 99.995, 123456.785]
    xs += [rng.randint(0, 10**6) / 1000 for _ in range(2000)] + [rng.uniform(-1e6, 1e6) for _ in range(1000)]
    xs += [rng.randint(0, 10**5) / 8 for _ in range(300)] + [round(rng.random(), 3) * rng.choice([.85, .7, 1.2]) for _ in range(1000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for digits in (0, 2, 3):
        for r in df.select("x", py_round(F.col("x"), digits).alias("r")).collect():
            assert r.r == round(r.x, digits), (r.x, digits)
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,)], "x double").select(py_round(F.col("x")).alias("r")).collect()
    assert math.isnan(odd[0].r) and odd[1].r == math.inf and odd[2].r is None
