"""Key bitmaps, frequent values and lists that are unnested once."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import key_bitmaps as K
from tessera.operators import profile as P
from tessera.operators import quality as Q
from tessera.plans.registry import QUERIES
from tessera.sinks.writers import group_files

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bits_and_reports(spark):
    parent = spark.createDataFrame([(k,) for k in [-40000, -3, 0, 1, 7, 32768, 32769, 10**12]] + [(None,)], "id bigint")
    keys = [-40000, -3, -3, 0, 1, 1, 1, 2, 8, 32768, 32770, 10**12, 10**12 + 1, None, None]
    child = spark.createDataFrame([(k, 5) for k in keys], "fk bigint, other bigint")
    fks = {"fk": (parent, "id"), "other": (parent.limit(0), "id")}
    distinct = {k for k in keys if k is not None}
    known = {r.id for r in parent.collect()}
    assert {tuple(r) for r in K.key_report(child, fks).collect()} == {("fk", len(distinct), len(distinct - known)), ("other", 1, 1)}
    rows = sum(k is not None and k not in known for k in keys)
    assert {tuple(r) for r in K.orphan_rows(child, fks).collect()} == {("fk", rows), ("other", len(keys))}
    assert {tuple(r) for r in K.key_report(child.limit(0), fks).collect()} == {("fk", 0, 0), ("other", 0, 0)}
    assert {tuple(r) for r in K.orphan_rows(child.limit(0), fks).collect()} == {("fk", 0), ("other", 0)}


def test_the_fact_sends_bitmaps_only(spark):
    """One exchange of the child's bitmaps, made by a partial aggregate."""
    child = spark.range(100_000).select((F.col("id") % 1000).alias("fk"))
    parent = spark.range(500).select(F.col("id").alias("pk"))
    maps = K.key_bitmaps(child, ["fk"])
    assert maps.count() == 2 and _plan(maps).count("Exchange hashpartitioning") == 1  # key 0 has a bucket of its own
    assert "partial_bitmap_construct_agg" in _plan(maps)
    assert K.key_report(child, {"fk": (parent, "pk")}).first()[1:] == (1000, 500)


def test_key_conflicts_read_the_sheet_twice_at_most(spark):  # CLN5
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, "b", "y"), (5, None, "x"), (6, None, "x"), (7, "c", None), (8, "c", None)],
                               "o int, k string, n string")
    kept, dropped = Q.resolve_key_conflicts(df, "k", ["n"], "o")
    assert sorted(r.o for r in kept.collect()) == [1, 5, 6, 7]
    assert {(r.o, r.reason) for r in dropped.collect()} == {(2, "resubmitted_duplicate"), (3, "conflicting_identity"), (4, "conflicting_identity"),
                                                          (8, "resubmitted_duplicate")}
    kept, _ = Q.resolve_key_conflicts(spark.read.parquet(f"{SF}/customer.parquet"), "c_custkey", ["c_name"], "c_custkey")
    assert _plan(kept).count("FileScan") == 2


@pytest.mark.parametrize("name", ["basket_ranking", "basket_flat_sales"])
def test_lists_are_split_once(spark, name):  # JN10, JN11
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_frequent_values_are_exact(spark):
    n = 20_000
    df = spark.range(n).select(
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 13).cast("string")).alias("few"),
        F.col("id").cast("string").alias("all differ"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("hot"))
    for tracked in (64, P.TRACKED):
        got = {(r.column, r.bucket, r.freq) for r in P.frequent_values(df, df.columns, 3, tracked).collect()}
        want = set()
        for c in df.columns:
            counts = df.groupBy(F.coalesce(F.col(f"`{c}`"), F.lit("nan")).alias("v")).count().orderBy(F.desc("count"), "v").limit(3)
            want |= {(c, r.v, r["count"]) for r in counts.collect()}
        assert got == want


@pytest.mark.parametrize("tracked", [64, 512])
def test_sketch_overlooks_nothing_above_its_error(spark, tracked):
    """Values just above the bound among very many rare ones are always named."""
    n = 30_000
    bound = P.sketch_error(n, tracked)
    hot = int(bound) + 1
    k = min(8, int(n / 2 / hot))
    v = F.when(F.col("id") < hot * k, F.concat(F.lit("hot"), (F.col("id") % k).cast("string"))).otherwise(F.col("id").cast("string"))
    df = spark.range(n).select(v.alias("v")).repartition(7, F.xxhash64("v"))
    items = df.agg(F.call_function("approx_top_k", "v", F.lit(tracked), F.lit(tracked)).alias("t")).first()["t"]
    assert {f"hot{i}" for i in range(k)} <= {r["item"] for r in items}


def test_labels_that_differ_by_blanks_keep_their_folders(spark):  # SNK6
    df = spark.createDataFrame([("A B",), ("AB",), ("A  B",), ("C",), (None,)], "g string")
    files = {r._label: r._file for r in group_files(df, "g").collect()}
    assert len(set(files.values())) == 4 and files["C"] == "dades_C" and set(files) == {"A B", "AB", "A  B", "C"}
