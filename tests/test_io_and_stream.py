"""Sources (SRC*), sinks (SNK*), the streaming refresh (SNK4) and routing (PIP12)."""

import datetime as dt
import glob
import json
import os

import pytest

from tessera.operators.routes import greedy_routes
from tessera.sources.quarantine import read_with_ordinal
from tessera.operators.reshape import matrix_to_edges
from tessera.plans import employees as E
from tessera.plans import retail as R
from tessera.sinks import writers as W
from tessera.sources import files as S
from tessera.streaming.daily_sales import refresh_daily_sales


def _write(path, text, enc="utf-8"):
    with open(path, "w", encoding=enc) as f:
        f.write(text)
    return path


def test_delimited_variants(spark, tmp_out):  # SRC1-SRC3, SRC6, SRC7, SRC9
    a = _write(f"{tmp_out}/a.csv", 'id;name\n1;"Ana; B"\n2;Joan\n')
    b = _write(f"{tmp_out}/b.csv", "id;name\n3;Pau\n")
    df = S.read_delimited(spark, [a, b], schema=S.all_string_schema(["id", "name"]), sep=";", line_sep="\n")
    assert sorted((r.id, r.name) for r in df.collect()) == [("1", "Ana; B"), ("2", "Joan"), ("3", "Pau")]
    lat = _write(f"{tmp_out}/l.csv", "Ciutat,Pais\nLleida,Espanya\nGirona,França\n", enc="latin-1")
    got = S.read_delimited(spark, lat, encoding="ISO-8859-1").collect()
    assert got[1].Pais == "França"
    inferred = S.read_delimited(spark, b, sep=";", infer_schema=True)
    assert dict(inferred.dtypes)["id"] == "int"


def test_cards_expiry_transform(spark, tmp_out):  # SRC4
    p = _write(f"{tmp_out}/c.csv", "id,user_id,iban,pan,pin,cvv,track1,track2,expiring_date\n"
                                   "c1,7,X,P,1,2,t1,t2,01/01/75\nc2,8,X,P,1,2,t1,t2,02/30/24\n")
    got = {r.id: r.expiring_date for r in S.read_cards_csv(spark, p).collect()}
    assert got == {"c1": dt.date(1975, 1, 1), "c2": None}


def test_header_promotion_and_damaged_name(spark, tmp_out):  # SRC8, CLN1, CLN2, CLN4
    text = (",,\n,,\n,Nom,Grup Professional,CÃ\xa0rrec\n,Ana,A,Cap\n,Joan,B,Tec\n")
    p = _write(f"{tmp_out}/sheet.csv", text)
    raw = read_with_ordinal(spark, p, 4)
    promoted = E.promote_header(raw, 2)
    clean = E.canonical_names(promoted)
    assert clean.columns == ["_ord", "nom", "grup_professional", "càrrec"]
    assert [r.nom for r in clean.orderBy("_ord").collect()] == ["Ana", "Joan"]


def test_policy_json(spark, tmp_out):  # SRC10, MAP1
    p = _write(f"{tmp_out}/policy.json", json.dumps(E.DEFAULT_POLICY, indent=2))
    policy = S.read_policy(spark, p)
    rows = [("BUILDING", 1000.0, 0.0, dt.date(1990, 6, 1), 14.0, 100.0), ("other", 700.0, 2.0, None, 11.0, 40000.0), (None, None, 1.0, None, None, 0.0)]
    df = spark.createDataFrame(rows, "grup_professional string, salari_mensual double, nombre_fills double, data_naixement date, "
                                     "temperatura_mitjana_ciutat double, km_anuals double")
    by_document, by_mapping = E.apply_salary_policy(df, policy), E.apply_salary_policy(df, E.DEFAULT_POLICY)
    assert by_document.columns == by_mapping.columns and sorted(by_document.collect(), key=repr) == sorted(by_mapping.collect(), key=repr)


def test_policy_bands(spark):  # PIP28 edges
    ages = [17, 18, 29, 30, 44, 45, 59, 60, 61, None]
    rows = [(i, "BUILDING", 1000.0, 0.0, None if a is None else dt.date(2026 - a, 6, 1), 14.0, 100.0)
            for i, a in enumerate(ages)]
    rows += [(20, "BUILDING", 1000.0, 0.0, None, t, km) for t, km in
             [(11.9, 0.0), (12.0, None), (16.0, 30000.0), (16.1, 30001.0), (None, 5.0)]]
    rows += [(30, "UNMAPPED", 1000.0, 0.0, None, 14.0, 1.0), (31, "BUILDING", 500.0, 0.0, None, 14.0, 1.0)]
    df = spark.createDataFrame(rows, "id int, grup_professional string, salari_mensual double, nombre_fills double, "
                                     "data_naixement date, temperatura_mitjana_ciutat double, km_anuals double")
    out = E.apply_salary_policy(df).collect()
    by_age = [r.incremento_edad for r in out[:10]]
    assert by_age == [0.0, 0.5, 0.5, 1.0, 1.0, 1.5, 1.5, 0.0, 2.0, 0.0]
    bands = [(r.coste_de_vida, r.incremento_transporte) for r in out[10:15]]
    assert bands == [("high", 0.0), ("medium", 0.0), ("medium", 1.0), ("low", 2.0), ("medium", 1.0)]
    unm = out[15]
    assert unm.incremento_total is None and unm.nou_salari is None
    assert out[16].nou_salari == 800.0  # floor
    assert max(r.inc_total_porcentaje for r in out if r.inc_total_porcentaje is not None) <= 15.0


def test_children_and_car_rules(spark):  # CLN10, CLN11
    rows = [(1, 2.0, None, None, "True", None, 5.0),   # n>0, car with consumption but no km → km median
            (2, None, "True", None, None, 100.0, None),  # has children, n unknown → median of n>0
            (3, None, None, "True", "False", 50.0, 6.0),  # no_fills → 0; no car → 0/0
            (4, 4.0, "False", None, None, None, None)]   # n>0 overrides fills=False
    df = spark.createDataFrame(rows, "id int, nombre_fills double, fills string, no_fills string, "
                                     "te_cotxe string, km_anuals double, consum_mitja_l_100km double")
    ch = {r.id: (r.nombre_fills, r.fills) for r in E.children_rules(df).collect()}
    assert ch == {1: (2.0, True), 2: (3.0, True), 3: (0.0, False), 4: (4.0, True)}
    car = {r.id: (r.km_anuals, r.consum_mitja_l_100km, r.te_cotxe) for r in E.car_rules(df).collect()}
    assert car == {1: (100.0, 5.0, True), 2: (100.0, 5.0, True), 3: (0.0, 0.0, False), 4: (0.0, 0.0, False)}


def test_export_per_group(spark, tmp_out):  # SNK6, SNK7, SNK8
    df = spark.createDataFrame([("Grup A", 1), ("Grup A", 2), ("B", 3), (None, 4)], "g string, v int")
    W.export_per_group(df, "g", f"{tmp_out}/exp")
    dirs = sorted(os.path.basename(p) for p in glob.glob(f"{tmp_out}/exp/_file=*"))
    assert dirs == ["_file=dades_B", "_file=dades_GrupA"]
    back = spark.read.option("header", True).csv(f"{tmp_out}/exp/_file=dades_GrupA")
    assert back.columns == ["g", "v"] and back.count() == 2  # key column kept in the files
    W.export_single_csv(df.groupBy("g").count(), f"{tmp_out}/sum")
    assert len(glob.glob(f"{tmp_out}/sum/part-*.csv")) == 1
    W.export_bundle(df.groupBy("g").count(), df, "g", f"{tmp_out}/bundle")
    assert os.path.isdir(f"{tmp_out}/bundle/resumen_agregado") and len(glob.glob(f"{tmp_out}/bundle/grups/grup=*")) == 2


def test_partitioned_fact_prunes(spark, tmp_out):  # SNK2, PIP14, FLT5
    rows = [(str(i), f"b{i % 3}", dt.datetime(2024, 1, 1 + i % 20), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "transaction_id string, business_id string, timestamp timestamp_ntz, amount double")
    R.write_partitioned_fact(df, f"{tmp_out}/fact")
    fact = spark.read.parquet(f"{tmp_out}/fact")
    recent = R.recent_days(fact, "2024-01-20", 5)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert recent.count() == sum(1 for r in rows if r[2].date() >= dt.date(2024, 1, 15))


def test_streaming_refresh_is_incremental(spark, tmp_out):  # SNK4
    schema = "date date, amount double"
    fact = f"{tmp_out}/fact"
    b1 = spark.createDataFrame([(dt.date(2024, 1, 1), 1.25), (dt.date(2024, 1, 2), 2.0)], schema)
    b1.write.mode("append").partitionBy("date").parquet(fact)
    sch = spark.read.parquet(fact).schema
    table, ck = f"{tmp_out}/mv", f"{tmp_out}/ck"
    refresh_daily_sales(spark, fact, table, ck, sch)
    b2 = spark.createDataFrame([(dt.date(2024, 1, 2), 3.0), (dt.date(2024, 1, 3), 4.0)], schema)
    b2.write.mode("append").partitionBy("date").parquet(fact)
    refresh_daily_sales(spark, fact, table, ck, sch)
    got = {r.fecha: float(r.total_vendes) for r in spark.read.parquet(table).collect()}
    assert got == {dt.date(2024, 1, 1): 1.25, dt.date(2024, 1, 2): 5.0, dt.date(2024, 1, 3): 4.0}


def _brute_routes(edges, reqs):
    dist = {}
    for s, d, km, o in edges:
        if km is not None and s != d:
            dist.setdefault(s, []).append((km, o, d))
    cities = {e[0] for e in edges if e[2] is not None and e[0] != e[1]} | {e[1] for e in edges if e[2] is not None and e[0] != e[1]}
    out = {}
    for rid, a, b in reqs:
        if a not in cities or b not in cities:
            out[rid] = (None, None, "unknown city")
            continue
        cur, vis, tot, err = a, [a], 0.0, None
        while cur != b:
            c = [x for x in dist.get(cur, []) if x[2] not in vis]
            if not c:
                err = "dead end"
                break
            km, _, nxt = min(c)
            tot, cur = tot + km, nxt
            vis.append(nxt)
        out[rid] = (vis, tot, err)
    return out


def test_routes_match_brute_force(spark):  # PIP12, RSH4, JN17, ARR4
    names = ["Barcelona", "Girona", "Lleida", "Tarragona", "Palma"]
    km = [[0, 100, 160, 100, 200], [100, 0, 230, 180, 240], [160, 230, 0, 90, 300],
          [100, 180, 90, 0, None], [200, 240, 300, None, 0]]
    km[2][1] = 160.0  # tie from Lleida: Barcelona and Girona at 160 → first column wins
    rows = [(n, *[None if v is None else float(v) for v in km[i]]) for i, n in enumerate(names)]
    mx = spark.createDataFrame(rows, "city string, " + ", ".join(f"{n} double" for n in names))
    edges = matrix_to_edges(mx, exclude=["Palma", "Las Palmas de Gran Canaria"])
    reqs = [(1, "Lleida", "Girona"), (2, "Barcelona", "Barcelona"), (3, "Palma", "Girona"), (4, "Girona", "Lleida")]
    got = greedy_routes(spark.createDataFrame(reqs, "req_id int, origin string, destination string"), edges)
    exp = _brute_routes([tuple(r) for r in edges.collect()], reqs)
    res = {r.req_id: (r.route, r.total_km, r.error) for r in got.collect()}
    assert res == exp
    assert res[1][0] == ["Lleida", "Tarragona", "Barcelona", "Girona"]
    assert res[2] == (["Barcelona"], 0.0, None) and res[3][2] == "unknown city"


def test_streaming_batch_replay_is_idempotent(spark, tmp_out):  # SNK4 failure safety
    from tessera.streaming.daily_sales import _recompute_touched_dates
    schema = "date date, amount double"
    fact = f"{tmp_out}/fact"
    spark.createDataFrame([(dt.date(2024, 1, 1), 1.5), (dt.date(2024, 1, 1), 2.0)], schema) \
        .write.mode("append").partitionBy("date").parquet(fact)
    run = _recompute_touched_dates(spark, fact, f"{tmp_out}/mv")
    batch = spark.read.parquet(fact)
    run(batch, 0)
    run(batch, 0)  # the same micro-batch delivered again
    got = {r.fecha: float(r.total_vendes) for r in spark.read.parquet(f"{tmp_out}/mv").collect()}
    assert got == {dt.date(2024, 1, 1): 3.5}


def test_routes_know_every_label(spark):  # PIP12: no request is lost, isolated cities are known
    edges = spark.createDataFrame([("A", "B", 1.0, 1), ("B", "A", 1.0, 0), ("A", "Z", None, 2), ("Z", "A", None, 0),
                                   ("B", "C", 2.0, 2), ("A", "C", 5.0, 3)], "src string, dst string, km double, ord int")
    ask = [(1, "A", "C"), (2, "A", "Z"), (3, "Z", "Z"), (4, "Z", "A"), (5, "A", "Q"), (6, None, "A")]
    got = {r.req_id: (r.route, r.total_km, r.error) for r in greedy_routes(
        spark.createDataFrame(ask, "req_id int, origin string, destination string"), edges).collect()}
    assert got == {1: (["A", "B", "C"], 3.0, None), 2: (["A", "B", "C"], 3.0, "dead end"), 3: (["Z"], 0.0, None),
                   4: (["Z"], 0.0, "dead end"), 5: (None, None, "unknown city"), 6: (None, None, "unknown city")}


def test_scratch_folder_must_be_shared():
    from tessera.session import local_scratch
    with pytest.raises(RuntimeError):
        local_scratch("spark://host:7077")
    assert local_scratch("local[2]")


def test_refresh_reads_touched_directories_only(spark, tmp_out):  # SNK4
    from tessera.streaming.daily_sales import totals_of
    rows = [(dt.date(2024, 1, d), 1.0) for d in range(1, 9)]
    spark.createDataFrame(rows, "date date, amount double").write.partitionBy("date").parquet(f"{tmp_out}/f")
    plan = totals_of(spark.read.parquet(f"{tmp_out}/f"), [dt.date(2024, 1, 3)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-03" in plan


def test_large_day_becomes_several_files(spark, tmp_out):  # SNK2
    import glob
    from tessera.plans.retail import write_partitioned_fact
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 60_000, 1, 8).selectExpr("id as business_id", "md5(cast(id as string)) as note",
                                                    "timestamp_ntz'2024-01-01 10:00:00' as timestamp")
        write_partitioned_fact(df, f"{tmp_out}/day")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(glob.glob(f"{tmp_out}/day/date=2024-01-01/*.parquet")) > 1
    assert spark.read.parquet(f"{tmp_out}/day").count() == 60_000
