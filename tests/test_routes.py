"""Routing: every request row is answered on its own, whatever its id, out-degree or number of cities."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.routes import _hops, greedy_routes, neighbour_lists
from tests.test_io_and_stream import _brute_routes

ASK = "req_id int, origin string, destination string"


def answer(rows, edges):
    """One brute-force answer per request row."""
    return sorted(((rid, *_brute_routes(edges, [(0, a, b)])[0]) for rid, a, b in rows), key=repr)


def answered(df):
    return sorted(((r.req_id, r.route, r.total_km, r.error) for r in df.collect()), key=repr)


def test_repeated_request_ids_stay_apart(spark):
    edges = spark.createDataFrame([("a", "b", 1.0, 1), ("b", "c", 2.0, 2), ("a", "c", 5.0, 2), ("b", "a", 1.0, 0)],
                                  "src string, dst string, km double, ord int")
    rows = [(1, "a", "c"), (1, "b", "c"), (2, "a", "b"), (None, "a", "b"), (None, "b", "c"), (1, "a", "c")]
    got = greedy_routes(spark.createDataFrame(rows, ASK), edges)
    assert got.count() == len(rows)
    assert answered(got) == answer(rows, [tuple(r) for r in edges.collect()])


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_many_cities_and_small_chunks(spark, chunk):
    """More cities than one word of bits, lists of several chunks, ties in distance."""
    rng = random.Random(chunk)
    names = [f"city{i:03d}" for i in range(90)]
    edges = [(a, b, float(rng.randint(1, 9)), j) for a in names[:80] for j, b in enumerate(names) if a != b and rng.random() < 0.15]
    edges += [(a, a, 0.0, 0) for a in names[:5]]
    rows = [(rng.randint(1, 20), rng.choice(names), rng.choice(names)) for _ in range(60)] + [(99, "nowhere", names[0])]
    used = {e[0] for e in edges if e[0] != e[1]} | {e[1] for e in edges if e[0] != e[1]}
    rows = [r for r in rows if {r[1], r[2]} <= used or r[0] == 99]
    got = greedy_routes(spark.createDataFrame(rows, ASK), spark.createDataFrame(edges, "src string, dst string, km double, ord int"), chunk)
    assert answered(got) == answer(rows, edges)


def test_a_hop_has_one_row_per_request(spark):
    edges = spark.createDataFrame([("hub", f"c{i}", float(i), i) for i in range(500)], "src string, dst string, km double, ord int")
    numbers = spark.createDataFrame([("hub", 0)] + [(f"c{i}", i + 1) for i in range(500)], "city string, no bigint")
    lists = neighbour_lists(edges, numbers, 64)
    assert lists.count() == 8 and lists.agg(F.max(F.size("items"))).first()[0] == 64
    state = spark.range(10).select(
        F.col("id").alias("row"), F.lit(1).alias("req_id"), F.lit("hub").alias("origin"), F.lit("c9").alias("destination"),
        F.lit(0).cast("bigint").alias("cur"), F.lit(0).cast("bigint").alias("cursor"),
        F.array_repeat(F.lit(0).cast("bigint"), 8).alias("seen"), F.array(F.lit("hub")).alias("route"), F.lit(0.0).alias("total_km"),
        F.lit("open").alias("status"))
    hop = _hops(lists)(state)
    assert hop.count() == 10 and "Aggregate" not in hop._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
