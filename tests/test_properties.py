"""Property checks from the test strategy: imputation leaves
non-NULL values alone, keep-first dedup is idempotent, explode count equals
the sum of array sizes, the last year-to-date value equals the yearly sum."""

import random

from pyspark.sql import functions as F

from tessera.operators.relational import fill_from_group_then_global, keep_first
from tessera.plans import retail as R
from tessera.sources import retail as src
from tessera.sources.tables import Tables

from .conftest import SF_SMALL


def _random_rows(seed, n=300):
    rnd = random.Random(seed)
    return [(i, rnd.choice(["a", "b", "c", None]), None if rnd.random() < 0.3 else round(rnd.uniform(0, 100), 2))
            for i in range(n)]


def test_imputation_keeps_non_null_values(spark):
    for seed in (1, 2, 3):
        df = spark.createDataFrame(_random_rows(seed), "ord int, g string, x double")
        out = {r.ord: r.x for r in fill_from_group_then_global(df, "g", "x").collect()}
        for o, _, x in _random_rows(seed):
            if x is not None:
                assert out[o] == x
        assert all(v is not None for v in out.values())


def test_keep_first_is_idempotent(spark):
    df = spark.createDataFrame(_random_rows(7), "ord int, g string, x double")
    once = keep_first(df, ["g"], "ord")
    twice = keep_first(once, ["g"], "ord")
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)
    assert once.count() == df.select("g").distinct().count()


def test_explode_count_equals_sum_of_sizes(spark):
    s = src.transactions_silver(src.transactions_raw(Tables(spark, SF_SMALL)))
    total = s.agg(F.sum(F.coalesce(F.array_size("product_ids"), F.lit(0)))).first()[0]
    assert s.select(F.explode("product_ids")).count() == total
    assert src.transaction_lines(Tables(spark, SF_SMALL)).count() == total


def test_ytd_last_equals_yearly_sum(spark):
    s = src.transactions_silver(src.transactions_raw(Tables(spark, SF_SMALL)))
    mv = R.daily_sales(s.withColumn("date", F.to_date("timestamp")))
    ytd = R.year_to_date(mv)
    last = ytd.groupBy(F.year("Data").alias("y")).agg(F.max_by("Vendes_Acumulades_YTD", "Data").alias("last"))
    yearly = mv.groupBy(F.year("fecha").alias("y")).agg(F.sum(F.round("total_vendes", 2)).cast("double").alias("s"))
    for r in last.join(yearly, "y").collect():
        assert abs(r["last"] - r["s"]) < 1e-6
