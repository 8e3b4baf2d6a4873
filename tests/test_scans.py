"""Ordinals, ranks, lags and running sums against plain Python; no window without partitions."""

import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators.ordinals import stable_rank, with_ordinal
from tessera.operators.scans import global_lag, running_sum
from tessera.plans import scoring as SC
from tessera.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def frame(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, Decimal(rng.randint(-500, 500)) / 100])) for i in range(n)]
    return rows, spark.createDataFrame(rng.sample(rows, n), "i int, k string, v decimal(10,2)").repartition(5)


def test_ordinals(spark):
    rows, df = frame(spark)
    got = {r.i: r.at for r in with_ordinal(df, [F.desc("i")], "at").collect()}
    assert got == {i: len(rows) - 1 - i for i, _, _ in rows}
    equal = with_ordinal(df, [F.lit(1)], "at", start=1)  # nothing tells the rows apart
    assert sorted(r.at for r in equal.collect()) == list(range(1, len(rows) + 1))
    assert with_ordinal(df.limit(0), ["i"]).count() == 0


def test_stable_rank(spark):
    rows = [(i, s) for i, s in enumerate([3.0, 1.0, None, 3.0, 2.0, 1.0, 3.0])]
    got = {r.ord: r.rank for r in stable_rank(spark.createDataFrame(rows, "ord int, s double"), "s", "ord").collect()}
    want = sorted((r for r in rows if r[1] is not None), key=lambda r: r[1], reverse=True) + [rows[2]]
    assert got == {o: k for k, (o, _) in enumerate(want, 1)}


def test_lag(spark):
    rows, df = frame(spark)
    got = {r.i: (r.pv, r.pk) for r in global_lag(df, ["i"], {"pv": "v", "pk": "k"}).collect()}
    before = [(None, None), *[(v, k) for _, k, v in rows[:-1]]]
    assert got == {i: b for (i, _, _), b in zip(rows, before)}


@pytest.mark.parametrize("by", [None, "k"])
def test_running_sum(spark, by):
    rows, df = frame(spark)
    got = {r.i: r.total for r in running_sum(df, ["i"], "v", "total", by).collect()}
    sums, want = {}, {}
    for i, k, v in rows:
        k = k if by else 0
        if v is not None:
            sums[k] = sums.get(k, 0) + v
        want[i] = sums.get(k)
    assert got == want
    one_key = df.withColumn("k", F.lit("x"))
    assert {r.i: r.t for r in running_sum(one_key, ["i"], "v", "t", "k").collect()} == {
        r.i: r.t for r in running_sum(df, ["i"], "v", "t").collect()}


@pytest.mark.parametrize("name", ["transaction_changes", "candidate_report", "triage_report", "insurance_by_fraud", "insurance_by_price"])
def test_no_window_without_partitions(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_strict_lookups_fail_on_a_miss(spark):  # JN13
    clients = spark.createDataFrame([(1, 0, "18-25"), (2, 9, "26-40")], "id_client int, codi_comportament int, grup_edat string")
    assert SC.cart_risk(clients).where("id_client = 2").first().risc_final is None
    with pytest.raises(PySparkException, match="unmapped key: 9"):
        SC.cart_risk(clients, strict=True).collect()
    records = spark.createDataFrame([(1, "Ana|30|tos, Fiebre Alta"), (2, "Pau|40|hipo")], "ord int, record string")
    assert [r.riesgo_total for r in SC.triage(records).orderBy("ord").collect()] == [4, None]
    with pytest.raises(PySparkException, match="unmapped key: hipo"):
        SC.triage(records, strict=True).collect()


def test_answers_read_the_input_once(spark):  # AGG21
    plan = QUERIES["cart_risk_extremes"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("event_type#") and plan.count("Relation ") == 1
    empty = spark.createDataFrame([], "id_client int, codi_comportament int, risc_final double")
    assert SC.cart_extremes(empty).count() == 0
