"""Rejects, row numbers over split files, raw sheets, checked writes and keyed maintenance."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.clean import drop_unrecoverable
from tessera.operators.keyed_table import ChangeRefusedError, KeyedTable
from tessera.operators.relational import dedupe_column_names
from tessera.plans import employees as E
from tessera.sinks import checked as K
from tessera.sources.quarantine import read_with_ordinal, read_with_rejects

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("v", T.DoubleType())])


def put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


# ------------------------------------------------------------------ SRC1-SRC9
def test_rows_and_rejects(spark, tmp_out):
    a = put(f"{tmp_out}/a.csv", "id;name;v\n1;ñu;2.5\nx;bad id;1\n3;too few\n4;too;1;many\n5;\"quoted; name\";\n")
    b = put(f"{tmp_out}/b.csv", "id;name;v\n6;six;6\n")
    rows, rejects = read_with_rejects(spark, [a, b], SCHEMA, sep=";")
    assert {tuple(r) for r in rows.collect()} == {(1, "ñu", 2.5), (5, "quoted; name", None), (6, "six", 6.0)}
    assert {(r._file, r._block, r._line) for r in rejects.collect()} == {
        ("a.csv", 0, "x;bad id;1"), ("a.csv", 0, "3;too few"), ("a.csv", 0, "4;too;1;many")}
    old = put(f"{tmp_out}/old.csv", "id,name,v\n1,años,1\n", "latin-1")
    assert read_with_rejects(spark, old, SCHEMA, encoding="ISO-8859-1")[0].first().name == "años"
    none = put(f"{tmp_out}/none.csv", "id,name,v\n")
    assert [x.count() for x in read_with_rejects(spark, none, SCHEMA)] == [0, 0]


def test_ordinals_over_split_files(spark, tmp_out):
    """Several files, each read by several tasks."""
    n = 0
    for k in range(3):
        lines = [f"{n + i},{'x' * (i % 17)}" for i in range(400 + 100 * k)]
        n += len(lines)
        put(f"{tmp_out}/s/part-{k}.csv", "\n".join(lines) + "\n")
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        read = spark.read.csv(f"{tmp_out}/s")
        assert read.rdd.getNumPartitions() > 6
        got = [(int(r._c0), r.at) for r in read_with_ordinal(spark, f"{tmp_out}/s", 2, "at").collect()]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert len(got) == n and all(value == at for value, at in got)


# ------------------------------------------------------------------ CLN1-CLN4, SET3
def test_raw_sheet(spark, tmp_out):
    path = put(f"{tmp_out}/sheet.csv", "Enquesta,,,,,\n,,any,,,\n, Nom ,DNI,Grup Professional,CÃ\xa0rrec,Nom\n"
                                       ",Ana,1,A,Cap,again\n,,,,,\n,Joan,2,B,Tec,again\n")
    raw = read_with_ordinal(spark, path, 6)
    sheet = E.promote_header(raw, 2)
    assert sheet.columns == ["_ord", "Nom", "DNI", "Grup Professional", "CÃ\xa0rrec"]
    kept = drop_unrecoverable(sheet, ["Nom", "DNI"])
    assert sorted((r._ord, r.Nom) for r in kept.collect()) == [(3, "Ana"), (5, "Joan")]
    assert E.canonical_names(kept).columns == ["_ord", "nom", "dni", "grup_professional", "càrrec"]
    with pytest.raises(ValueError):
        E.promote_header(raw, 99)


def test_repeated_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int").toDF("x", "y", " x ", "x")
    out = dedupe_column_names(df)
    assert out.columns == ["x", "y"] and tuple(out.first()) == (1, 2)


# ------------------------------------------------------------------ DQ1-DQ4
def test_a_violation_leaves_the_old_table(spark, tmp_out):
    good = spark.createDataFrame([(1, "a", 1.0), (2, "b", None)], SCHEMA)
    with pytest.raises(FileNotFoundError):
        K.read_published(spark, tmp_out)
    done = K.write_checked(good, tmp_out, {**K.not_null("id", "name"), **K.in_range("v", 0, 10)})
    assert (done.version, done.metrics) == (1, {"rows": 2, "null_id": 0, "null_name": 0, "range_v": 0})
    bad = spark.createDataFrame([(3, None, 11.0), (None, None, 5.0)], SCHEMA)
    with pytest.raises(K.ChecksFailedError) as e:
        K.write_checked(bad, tmp_out, {**K.not_null("id", "name"), **K.in_range("v", 0, 10)})
    assert e.value.metrics == {"rows": 2, "null_id": 1, "null_name": 2, "range_v": 1}
    assert sorted(r.id for r in K.read_published(spark, tmp_out).collect()) == [1, 2]
    again = K.write_checked(good.limit(1), tmp_out, K.not_null("id"))
    assert again.version == 2 and K.read_published(spark, tmp_out).count() == 1
    empty = K.write_checked(good.limit(0), tmp_out, K.not_null("id"))
    assert empty.metrics["rows"] == 0 and K.read_published(spark, tmp_out).count() == 0


# ------------------------------------------------------------------ MUT1-MUT5
def files(root):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{root}/data/**/*.parquet", recursive=True)}


def content(table):
    return {tuple(r) for r in table.read().collect()}


def test_changes_rewrite_touched_buckets_only(spark, tmp_out):
    start = {(i, f"n{i}", float(i)) for i in range(200)}
    table = KeyedTable.create(spark.createDataFrame(sorted(start), SCHEMA), tmp_out, "id", buckets=16)
    before = files(tmp_out)
    changes = spark.createDataFrame([(3, "update", None), (7, "delete", None), (500, "insert", "new"), (999, "update", "nobody"), (998, "delete", "x")],
                                    "id bigint, op string, name string")
    told = table.apply(changes)
    assert {k: told[k] for k in ("insert", "update", "delete")} == {"insert": 1, "update": 1, "delete": 1}
    assert told["buckets"] <= 5
    want = {r for r in start if r[0] not in (3, 7)} | {(3, None, 3.0), (500, "new", None)}
    assert content(table) == want
    assert all(files(tmp_out)[f] == t for f, t in before.items())  # old files are as they were
    live = {f for v, f in table._folders().values() if v == 1}
    assert len(live) >= 11  # untouched buckets still are the first version's
    table.apply(spark.createDataFrame([(3, "update", "x", 1.0)], "id bigint, op string, name string, v double"), sets=["v"])
    assert (3, None, 1.0) in content(table)


def test_a_bucket_may_become_empty(spark, tmp_out):
    table = KeyedTable.create(spark.createDataFrame([(1, "a", 1.0)], SCHEMA), tmp_out, "id", buckets=2)
    table.apply(spark.createDataFrame([(1, "delete")], "id bigint, op string"))
    assert content(table) == set() and table.read().columns == ["id", "name", "v"]
    table.apply(spark.createDataFrame([(1, "insert", "b")], "id bigint, op string, name string"))
    assert content(table) == {(1, "b", None)}
    assert table.apply(spark.createDataFrame([], "id bigint, op string"))["buckets"] == 0


@pytest.mark.parametrize("rows", [[(1, "update"), (1, "delete")], [(None, "delete")], [(2, "upsert")], [(2, None)], [(1, "insert")]])
def test_refused_changes_leave_the_table(spark, tmp_out, rows):
    table = KeyedTable.create(spark.createDataFrame([(1, "a", 1.0)], SCHEMA), tmp_out, "id", buckets=2)
    with pytest.raises(ChangeRefusedError):
        table.apply(spark.createDataFrame(rows, "id bigint, op string"))
    assert content(table) == {(1, "a", 1.0)}


def test_an_unfinished_set_is_not_seen(spark, tmp_out, monkeypatch):
    """The job dies after its files are written and before the log: readers see the old rows."""
    table = KeyedTable.create(spark.createDataFrame([(i, "a", 1.0) for i in range(20)], SCHEMA), tmp_out, "id", buckets=4)
    before = content(table)
    monkeypatch.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        table.apply(spark.range(1).select(F.lit(5).cast("bigint").alias("id"), F.lit("delete").alias("op")))
    monkeypatch.undo()
    assert content(table) == before
