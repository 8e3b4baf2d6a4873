"""Edge rows of the retail model (FIXTURES C) and of the profiling reports."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import profile as P
from tessera.plans import retail as R
from tessera.sinks import writers as W
from tessera.sources import retail as src
from tessera.sources.tables import Tables

from .conftest import SF_SMALL


def test_silver_typing_edges(spark):  # PIP11, CST2, CND2, ARR1
    raw = spark.createDataFrame([
        ("t1", "c", "b", "2024-01-01 05:00:00", "", "0", "5, 5, 7", "u"),
        ("t2", "c", "b", "not a time", "abc", "1", "x, 3", "u"),
        ("t3", "c", "b", "2024-01-01 00:00:00", None, "0", None, "u")],
        "id string, card_id string, business_id string, timestamp string, amount string, "
        "declined string, product_ids string, user_id string")
    s = {r.transaction_id: r for r in src.transactions_silver(raw).collect()}
    assert [s[k].amount for k in ("t1", "t2", "t3")] == [0.0, 0.0, 0.0]  # IFNULL(SAFE_CAST, 0)
    assert s["t2"].timestamp is None and s["t1"].timestamp == dt.datetime(2024, 1, 1, 5)
    assert s["t1"].product_ids == [5, 5, 7] and s["t2"].product_ids == [None, 3] and s["t3"].product_ids is None


def test_timestamp_equals_date_literal_is_midnight_only(spark):  # FLT7
    comp = spark.createDataFrame([(1, "Acme", "Germany")], "company_id bigint, company_name string, country string")
    tx = spark.createDataFrame([("a", "1", dt.datetime(2022, 3, 12, 0, 0)), ("b", "1", dt.datetime(2022, 3, 12, 5, 0))],
                               "transaction_id string, business_id string, timestamp timestamp_ntz")
    got = R.company_transactions_at(comp, tx, "Germany", "2022-03-12 00:00:00").collect()
    assert [r.transaction_id for r in got] == ["a"]


def test_users_union_origin(spark):  # SET1, PRJ3
    u = src.users(Tables(spark, SF_SMALL))
    origins = {r.origin for r in u.select("origin").distinct().collect()}
    assert origins == {"America", "Europe"}
    assert u.groupBy("user_id").count().filter("count > 1").count() == 0


def test_profile_and_describe_kinds(spark):  # PRF1, AGG19
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1.0, "a"), (dt.date(2020, 5, 1), 3.0, None),
                                (dt.date(2021, 1, 1), None, "a")], "d date, x double, t string")
    prof = {(r.column, r.kind, r.bucket): r.freq for r in P.profile_table(df, top=10, bins=2).collect()}
    assert prof[("d", "year", "2020")] == 2 and prof[("t", "top_value", "nan")] == 1
    assert prof[("x", "histogram", "00")] == 1 and prof[("x", "histogram", "01")] == 1
    desc = {(r.column, r.stat): r.value if r.text is None else r.text for r in P.describe(df, ["x", "t"]).collect()}
    assert desc[("x", "count")] == 2 and desc[("x", "mean")] == 2.0 and desc[("t", "top")] == "a"
    four = P.describe(spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int"))
    assert {r.stat: r.value for r in four.collect() if "%" in r.stat} == {"25%": 1.75, "50%": 2.5, "75%": 3.25}
    inf = spark.createDataFrame([(float("inf"),), (None,)], "v double")
    rep = P.null_counts(inf, with_infinite=True).first()
    assert (rep.nulls, rep.infinite) == (1, 1)


def test_refresh_touches_only_given_dates(spark, tmp_out):  # SNK4
    path = f"{tmp_out}/mv"
    first = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 1, 2), 2.0)], "fecha date, total_vendes double")
    W.refresh_daily_partitions(first, path)
    W.refresh_daily_partitions(spark.createDataFrame([(dt.date(2024, 1, 2), 9.0)], "fecha date, total_vendes double"), path)
    got = {r.fecha: r.total_vendes for r in spark.read.parquet(path).collect()}
    assert got == {dt.date(2024, 1, 1): 1.0, dt.date(2024, 1, 2): 9.0}


def test_redate_is_repeatable_and_bounded(spark):  # PIP13, MTH9, DAT4
    s = src.transactions_silver(src.transactions_raw(Tables(spark, SF_SMALL)))
    a = R.redate(s, "2001-08-01 00:00:00")
    b = R.redate(s, "2001-08-01 00:00:00")
    assert a.exceptAll(b).count() == 0
    rng = a.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    assert rng.hi <= dt.datetime(2001, 8, 1) and rng.lo >= dt.datetime(2001, 6, 11)


def test_small_functions_and_writers(spark, tmp_out):  # STR1, STR2, STR10, ARR3, DAT4, SNK1, SNK3
    from tessera.functions import arrays as A
    from tessera.functions import dates as D
    from tessera.functions import text as X
    df = spark.createDataFrame([("WH-12", "a|b|c", ["Fiebre Alta ", " tos"])], "w string, p string, s array<string>")
    r = df.select(X.substr_from(F.col("w"), 4).alias("x"), X.split_list(F.col("p"), "|").alias("y"),
                  A.normalise_items(F.col("s")).alias("z"), A.join_list(F.col("s"), "+").alias("j"),
                  D.days_before("2024-03-01 00:00:00", 30).alias("d")).first()
    assert (r.x, r.y, r.z, r.j) == ("12", ["a", "b", "c"], ["fiebre_alta", "tos"], "Fiebre Alta + tos")
    assert r.d == dt.datetime(2024, 1, 31)
    W.replace_table(df.select("w"), f"{tmp_out}/t")
    W.replace_table(df.select("p"), f"{tmp_out}/t")  # create-or-replace
    assert spark.read.parquet(f"{tmp_out}/t").columns == ["p"]
    W.view(df, "tessera_view_test")
    assert spark.sql("SELECT count(*) AS n FROM tessera_view_test").first().n == 1


def test_bucketed_tables_join_without_shuffle(spark):  # SNK1/SNK2 catalog variant
    a = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    b = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("w"))
    W.save_as_table(a, "tessera_bucket_a", bucket_by="k", buckets=8)
    W.save_as_table(b, "tessera_bucket_b", bucket_by="k", buckets=8)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("tessera_bucket_a").join(spark.table("tessera_bucket_b"), "k")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", prev)


def test_margins_wide(spark):  # AGG15 wide form
    from tessera.operators.reshape import margins_wide, pivot_with_margins
    df = spark.createDataFrame([("H", "ES", 10.0), ("D", "ES", 40.0), ("D", "FR", 50.0)], "g string, p string, s double")
    wide = {r.g: r.asDict() for r in margins_wide(pivot_with_margins(df, "g", "p", "s"), "g", "p", ["ES", "FR"]).collect()}
    assert wide["H"]["ES"] == 10.0 and wide["H"]["FR"] is None and wide["D"]["Mitjana_total"] == 45.0
    assert wide["Mitjana_total"]["Mitjana_total"] == 33.33


def test_card_with_three_latest_declined_is_inactive(spark):  # PIP9 / WIN1 edge
    tx = spark.createDataFrame([(1, 7, False), (2, 7, True), (3, 7, True), (4, 7, True), (5, 8, False)],
                               "transaction_id int, card_id int, declined boolean")
    assert R.active_cards(tx).first().total_tarjetas_activas == 1  # only card 8


def test_uncorrelated_exists_without_match_returns_nothing(spark):  # JN7 edge
    comp = spark.createDataFrame([(1, "Germany")], "company_id bigint, country string")
    tx = spark.createDataFrame([(10, 1, False), (11, 2, False), (12, 2, True)],
                               "transaction_id bigint, business_id bigint, declined boolean")
    assert R.transactions_if_country_exists(comp, tx, "Nowhere").count() == 0
    # with a match every accepted transaction comes back, whatever its company
    assert sorted(r.transaction_id for r in R.transactions_if_country_exists(comp, tx, "Germany").collect()) == [10, 11]


def test_day_variant_and_close_gap(spark):  # FLT7 day=, PIP28 close_gap
    comp = spark.createDataFrame([(1, "Acme", "Germany")], "company_id bigint, company_name string, country string")
    tx = spark.createDataFrame([("a", "1", dt.datetime(2022, 3, 12, 0, 0)), ("b", "1", dt.datetime(2022, 3, 12, 5, 0)),
                                ("c", "1", dt.datetime(2022, 3, 13, 0, 0))],
                               "transaction_id string, business_id string, timestamp timestamp_ntz")
    got = R.company_transactions_at(comp, tx, "Germany", "2022-03-12 00:00:00", day=True).collect()
    assert sorted(r.transaction_id for r in got) == ["a", "b"]
    from tessera.plans import employees as E
    df = spark.createDataFrame([("BUILDING", 1000.0, 0.0, dt.date(1966, 6, 1), 14.0, 1.0)],
                               "grup_professional string, salari_mensual double, nombre_fills double, "
                               "data_naixement date, temperatura_mitjana_ciutat double, km_anuals double")
    assert E.apply_salary_policy(df).first().incremento_edad == 0.0
    assert E.apply_salary_policy(df, close_gap=True).first().incremento_edad == 2.0


def _order_tables(spark, folder, lines, orders):
    lines.write.parquet(f"{folder}/lineitem.parquet")
    orders.write.parquet(f"{folder}/orders.parquet")
    return Tables(spark, folder)


def test_transaction_lines_of_odd_keys(spark, tmp_out):  # JN12, JN10
    lines = [(1, 5), (1, 5), (1, 7), (2, 7), (2, None), (3, 5), (None, 5), (9, 7), (9, 7)]
    orders = [(1,), (2,), (2,), (None,), (9,), (9,), (8,)]  # 3 is missing, 2 and 9 come twice
    t = _order_tables(spark, tmp_out, spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint"),
                      spark.createDataFrame(orders, "o_orderkey bigint"))
    got = src.transaction_lines(t)
    assert got.columns == ["transaction_id", "product_id"]
    kept = [x for x in lines if x[0] in (1, 2, 9)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(kept, key=repr)
    p = spark.createDataFrame([(5, "a"), (7, "b"), (8, "never")], "product_id bigint, name string")
    assert {r.id: r.veces_vendido for r in R.product_sales_membership_lines(got, p).collect()} == {5: 1, 7: 3}
    ps = p.withColumns({"price": F.lit(1.0), "colour": F.lit("x")})
    assert {r.product_id: r.total_sold for r in R.product_sales_ranking_lines(ps, got).collect()} == {5: 2, 7: 4, 8: 0}


def test_transaction_lines_parts_follow_the_rows(spark, tmp_out):
    """Few shuffle partitions, or AQE that joins them, leave no task with more rows than ``ROWS_A_TASK`` or so."""
    t = _order_tables(spark, tmp_out,
                      spark.range(900_000).selectExpr("id % 300000 AS l_orderkey", "id % 1009 AS l_partkey"),
                      spark.range(300_000).selectExpr("id AS o_orderkey"))
    keys = {"spark.sql.shuffle.partitions": "1", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        lines = src.transaction_lines(t)
        for rows in (lines, lines.distinct()):  # the distinct pairs stay where the lines were dealt
            tasks = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(tasks) == 900_000 and max(tasks) < 250_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
