"""Unit tests per operator ID on tiny frames, with the edge rows of FIXTURES C."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import dates as D
from tessera.functions import numeric as N
from tessera.functions import text as X
from tessera.operators import mutate as MU
from tessera.operators import profile as P
from tessera.operators import quality as Q
from tessera.operators import relational as RL
from tessera.operators import reshape as RS
from tessera.plans import retail as R


def col(df, c):
    return [r[c] for r in df.collect()]


# ------------------------------------------------------------------ functions
def test_id_list_keeps_bad_elements(spark):  # ARR1
    df = spark.createDataFrame([("5, 5, 7",), ("",), (None,), ("x, 3",)], "s string")
    got = col(df.select(A.id_list(F.col("s")).alias("a")), "a")
    assert got == [[5, 5, 7], [None], None, [None, 3]]


def test_membership_vs_unnest_counts(spark):  # JN12 vs JN10
    t = spark.createDataFrame([(1, "5, 5, 7"), (2, "7"), (3, None), (4, "")],
                              "transaction_id int, product_ids string")
    p = spark.createDataFrame([(5, "a"), (7, "b"), (9, "never")], "product_id bigint, name string")
    m = {r.id: r.veces_vendido for r in R.product_sales_membership(t, p).collect()}
    assert m == {5: 1, 7: 2}
    silver = t.select(A.id_list(F.col("product_ids")).alias("product_ids"))
    ps = p.withColumn("price", F.lit(1.0)).withColumn("colour", F.lit("x"))
    r = {x.product_id: x.total_sold for x in R.product_sales_ranking(ps, silver).collect()}
    assert r == {5: 2, 7: 2, 9: 0}


def test_mysql_short_date_pivot(spark):  # SRC4/DAT3
    df = spark.createDataFrame([("02/30/24",), ("01/01/75",), ("12/31/69",)], "s string")
    assert col(df.select(D.mysql_short_date(F.col("s")).alias("d")), "d") == [
        None, dt.date(1975, 1, 1), dt.date(2069, 12, 31)]


def test_date_from_parts_invalid(spark):  # DAT7
    df = spark.createDataFrame([(1990.0, 2.0, 31.0), (1990.0, 2.0, 28.0), (None, 1.0, 1.0)], "y double, m double, d double")
    assert col(df.select(D.date_from_parts(F.col("y"), F.col("m"), F.col("d")).alias("x")), "x") == [
        None, dt.date(1990, 2, 28), None]


def test_parse_amount_text(spark):  # CLN6
    vals = ["1500€", "1.500,5", "1500,5", "15.2", "euros", None, " 900 Euros "]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    assert col(df.select(X.parse_amount_text(F.col("s")).alias("x")), "x") == [
        1500.0, None, 1500.5, 15.2, None, None, 900.0]
    legacy = col(df.select(X.parse_amount_text(F.col("s"), legacy_order=True).alias("x")), "x")
    assert legacy[2] is None  # comma values coerced before the fix


def test_fix_mojibake_leaves_good_text(spark):  # STR9
    df = spark.createDataFrame([("JosÃ©",), ("José",), ("CompaÃ±ia",)], "s string")
    assert col(df.select(X.fix_mojibake(F.col("s")).alias("x")), "x") == ["José", "José", "Compañia"]


def test_normalise_key(spark):  # STR6
    df = spark.createDataFrame([("\t Fiebre Alta \n",)], "s string")
    assert col(df.select(X.normalise_key(F.col("s")).alias("x")), "x") == ["fiebre_alta"]


def test_clip_keeps_null_and_safe_divide(spark):  # MTH5, MTH3, MTH4
    df = spark.createDataFrame([(None, 5.0), (700.0, 0.0), (20.0, 10.0)], "a double, b double")
    out = df.select(N.clip_lower(F.col("a"), 800).alias("lo"), N.clip_upper(F.col("a"), 15).alias("hi"),
                    N.safe_divide(F.col("a"), F.col("b")).alias("q"), N.pct_change(F.col("a"), F.col("b")).alias("p"))
    rows = out.collect()
    assert [r.lo for r in rows] == [None, 800.0, 800.0]
    assert [r.hi for r in rows] == [None, 15.0, 15.0]
    assert [r.q for r in rows] == [None, None, 2.0]
    assert rows[2].p == 100.0


def test_tax_sql_function(spark):  # UDF1
    N.register_sql_functions(spark)
    assert spark.sql("SELECT calculate_tax(100.0) AS t").first().t == pytest.approx(121.0)


# ------------------------------------------------------------------ relational
def test_lookup_modes(spark):  # JN13/JN14/JN15
    df = spark.createDataFrame([(1, "D"), (2, "x"), (3, None)], "id int, g string")
    dim = spark.createDataFrame([("D", "Dona")], "k string, v string")
    nul = RL.lookup(df, dim, "g", "k", "null")
    assert sorted((r.id, r.v) for r in nul.collect()) == [(1, "Dona"), (2, None), (3, None)]
    keep = RL.lookup(df, dim, "g", "k", "keep", keep_col="g")
    assert sorted((r.id, r.g) for r in keep.collect()) == [(1, "Dona"), (2, "x"), (3, None)]
    with pytest.raises(RL.LookupMissError):
        RL.check_no_misses(df.filter("g is not null"), dim, "g", "k")
    with pytest.raises(Exception, match="unmapped key: x"):  # a miss fails the job, it drops no row
        RL.lookup(df.filter("g is not null"), dim, "g", "k", "error").collect()
    assert RL.lookup(df.filter("g = 'D'"), dim, "g", "k", "error").first().v == "Dona"


def test_keep_first_and_argmax(spark):  # SET2, AGG21
    df = spark.createDataFrame([(1, "a", 5.0), (2, "a", 9.0), (3, "b", 9.0)], "ord int, k string, s double")
    assert sorted(col(RL.keep_first(df, ["k"], "ord"), "ord")) == [1, 3]
    assert col(RL.arg_max(df, "s", "ord"), "ord") == [2]
    assert col(RL.arg_max(df, "s", "ord", lowest=True), "ord") == [1]


def test_transform_agg_null_group(spark):  # WIN6/JN16
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 7.0)], "g string, x double")
    out = {(r.g, r.x): r.median_x for r in RL.transform_agg(df, "g", "x").collect()}
    assert out == {("a", 1.0): 2.0, ("a", 3.0): 2.0, (None, 7.0): None}


def test_fill_group_then_global(spark):  # CLN8
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), (None, 10.0)], "g string, x double")
    out = sorted((r.g or "", r.x) for r in RL.fill_from_group_then_global(df, "g", "x").collect())
    # group a → 1; b all-NULL stays NULL → global median of (1, 1, 10) = 1
    assert out == [("", 10.0), ("a", 1.0), ("a", 1.0), ("b", 1.0)]


def test_value_counts_and_histogram(spark):  # AGG14, AGG26
    df = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "v string")
    vc = [(r.value, r.freq) for r in RL.value_counts(df, "v", as_text=True).collect()]
    assert vc == [("x", 2), ("nan", 1), ("y", 1)]
    h = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    got = {r.bucket: r.freq for r in RL.histogram(h, "x", 3).collect()}
    assert got == {0: 3, 1: 3, 2: 4}


def test_group_gap_and_share(spark):  # AGG25, AGG24
    df = spark.createDataFrame([("ES", "Home", 10.0), ("ES", "Dona", 6.0), ("FR", "Home", 4.0)],
                               "p string, g string, s double")
    gap = {r.p: r.gap for r in RL.group_gap(df, "p", "g", "Home", "Dona", "s").collect()}  # rounded to cents
    assert gap == {"ES": 4.0, "FR": None}
    share = {r.p: r.share for r in RL.share_of_rows(df, "p").collect()}
    assert share["ES"] == pytest.approx(2 / 3)


def test_dedupe_column_names(spark):  # SET3/CLN2
    df = spark.createDataFrame([(1, 2, 3)], ["a ", "b", "a"])
    out = RL.dedupe_column_names(df)
    assert out.columns == ["a", "b"] and out.first()[0] == 1


# ------------------------------------------------------------------ reshape / profile
def test_melt_pivot_roundtrip(spark):  # RSH1/RSH2
    df = spark.createDataFrame([("k1", 1.0, None), ("k2", 3.0, 4.0)], "id string, m1 double, m2 double")
    long = RS.melt(df, ["m1", "m2"])
    assert long.count() == 4  # NULL kept, like melt
    wide = RS.pivot_mean(long, "id", "metrica", "valor", ["m1", "m2"])
    assert sorted(map(tuple, wide.collect())) == [("k1", 1.0, None), ("k2", 3.0, 4.0)]


def test_pivot_margins_average_rows(spark):  # AGG15
    df = spark.createDataFrame([("H", "ES", 10.0), ("H", "ES", 20.0), ("D", "ES", 40.0), ("D", "FR", 50.0),
                                (None, "FR", 99.0)], "g string, p string, s double")
    m = {(r.g, r.p): r.mean for r in RS.pivot_with_margins(df, "g", "p", "s").collect()}
    assert m[("H", "ES")] == 15.0
    assert m[("Mitjana_total", "ES")] == 23.33  # mean of the 3 rows (70/3), not of the 2 cell means
    assert m[("Mitjana_total", "Mitjana_total")] == 30.0


def test_matrix_to_edges_excludes(spark):  # RSH4
    mx = spark.createDataFrame([("A", 0.0, 5.0, 1.0), ("B", 5.0, 0.0, 2.0), ("P", 1.0, 2.0, 0.0)],
                               "city string, A double, B double, P double")
    e = RS.matrix_to_edges(mx, exclude=["P", "Palma"])
    assert sorted((r.src, r.dst) for r in e.collect()) == [("A", "A"), ("A", "B"), ("B", "A"), ("B", "B")]


def test_null_and_duplicate_reports(spark):  # AGG18, AGG17, AGG20
    df = spark.createDataFrame([(1, None), (1, None), (None, "x")], "k int, v string")
    assert {r.column: r.nulls for r in P.null_counts(df).collect()} == {"k": 1, "v": 2}
    dup = {r.metric: r.value for r in P.duplicate_counts(df, "k").collect()}
    assert dup == {"duplicate_rows": 1, "duplicate_keys": 1}
    shape = {r.metric: r.value for r in P.shape_report(df.limit(1), before=df).collect()}
    assert shape == {"rows": 1, "columns": 2, "rows_before": 3}


def test_describe_text(spark):  # AGG19
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "t string")
    d = {r.stat: r.value if r.text is None else r.text for r in P.describe(df).collect()}
    assert d == {"count": 3, "unique": 2, "top": "b", "freq": 2}


# ------------------------------------------------------------------ quality / mutation
def test_key_conflicts(spark):  # CLN5
    rows = [(1, "K1", "Ana", "BCN"), (2, "K1", "Ana", "BCN"),   # resubmitted → keep first
            (3, "K2", "Ana", "BCN"), (4, "K2", "Joan", "MAD"),  # different people → drop both
            (5, None, "X", "Y"), (6, None, "Z", "Y"),           # NULL keys never merged
            (7, "K3", "Eva", None), (8, "K3", "Eva", None)]    # NULL identity field, same person
    df = spark.createDataFrame(rows, "ord int, dni string, nom string, ciutat string")
    kept, dropped = Q.resolve_key_conflicts(df, "dni", ["nom", "ciutat"], "ord")
    assert sorted(col(kept, "ord")) == [1, 5, 6, 7]
    assert sorted((r.ord, r.reason) for r in dropped.collect()) == [
        (2, "resubmitted_duplicate"), (3, "conflicting_identity"), (4, "conflicting_identity"),
        (8, "resubmitted_duplicate")]


def test_dq_checks(spark):  # DQ1-DQ4
    df = spark.createDataFrame([(1, 10), (1, 11), (None, 12), (2, None)], "k int, fk int")
    pk = Q.primary_key_violations(df, ["k"]).first()
    assert (pk.duplicate_keys, pk.rows_in_duplicate_keys, pk.rows_with_null_key) == (1, 2, 1)
    assert {r.column: r.nulls for r in Q.not_null_violations(df, ["k", "fk"]).collect()} == {"k": 1, "fk": 1}
    parent = spark.createDataFrame([(10,), (12,)], "id int")
    assert sorted(col(Q.orphans(df, "fk", parent, "id"), "fk")) == [11]
    assert col(Q.apply_defaults(df, {"fk": 0}).filter("k = 2"), "fk") == [0]


def test_mutations(spark):  # MUT1-MUT7
    df = spark.createDataFrame([("c1", "ES", "old"), ("c2", None, "x")], "id string, country string, iban string")
    ins = MU.insert_rows(df, spark.createDataFrame([("c9",)], "id string"))
    assert ins.filter("id = 'c9'").first().iban is None
    upd = MU.update_by_key(df, spark.createDataFrame([("c1", "NEW")], "id string, iban string"), "id")
    assert {r.id: r.iban for r in upd.collect()} == {"c1": "NEW", "c2": "x"}
    cont = MU.set_column_case(df, "continent", MU.continent_of(F.col("country")))
    assert {r.id: r.continent for r in cont.collect()} == {"c1": "Europe", "c2": "Europe"}
    dele = MU.delete_by_key(df, spark.createDataFrame([("c1",)], "id string"), "id")
    assert col(dele, "id") == ["c2"]
    assert MU.add_column(df, "x", "date").schema["x"].dataType.simpleString() == "date"
    assert MU.drop_columns(df, ["iban", "missing"]).columns == ["id", "country"]
    assert MU.rename_columns(df, {"iban": "IBAN", "nope": "z"}).columns == ["id", "country", "IBAN"]


# ------------------------------------------------------------------ windows (retail)
def test_third_purchase_peers_and_active_cards(spark):  # WIN2/WIN5, WIN1
    tx = spark.createDataFrame([
        ("1", "u", dt.datetime(2024, 1, 1), 10.0, "0"), ("2", "u", dt.datetime(2024, 1, 2), 20.0, "0"),
        ("3", "u", dt.datetime(2024, 1, 3), 30.0, "0"), ("4", "u", dt.datetime(2024, 1, 3), 60.0, "0"),
        ("5", "v", dt.datetime(2024, 1, 1), 5.0, "0")],
        "transaction_id string, user_id string, timestamp timestamp_ntz, amount double, declined string")
    users = spark.createDataFrame([(None, "u", "N", "S", "e")], "x string, user_id string, name string, surname string, email string").drop("x")
    out = R.third_purchase(users, tx).collect()
    assert len(out) == 1 and out[0].import_3a_compra == 30.0
    assert out[0].compra_media == 30.0  # RANGE frame: the 4th purchase at the same instant counts
    cards = spark.createDataFrame([(1, 1, True), (2, 1, True), (3, 1, True), (4, 1, False), (5, 2, False)],
                                  "transaction_id int, card_id int, declined boolean")
    # card 1: last three by id text desc are 4, 3, 2 and id 4 is accepted; card 2 accepted
    assert R.active_cards(cards).first().total_tarjetas_activas == 2


def test_small_clean_helpers(spark):  # CLN3, FLT4, FLT8, FLT10, SRT6, AGG16
    from tessera.operators import clean as C
    df = spark.createDataFrame([(1, "ABC", None), (2, None, None), (3, "x", 2.5), (3, "abc", 5.0)],
                               "k int, s string, v double")
    assert sorted(col(C.drop_unrecoverable(df, ["s", "v"]), "k")) == [1, 3, 3]
    assert sorted(col(df.filter(C.not_in_keep_null(F.col("s"), ["x"])), "k")) == [1, 2, 3]
    assert col(df.select(C.contains_ci(F.col("s"), "bC").alias("c")), "c") == [True, False, False, True]
    assert col(df.filter(C.mask_and_null(F.col("s"), "ABC", F.col("v"))), "k") == [1]
    assert col(C.duplicated_rows(df, "k"), "k") == [3, 3]
    assert sorted(col(C.distinct_values(df, "k"), "k")) == [1, 2, 3]
