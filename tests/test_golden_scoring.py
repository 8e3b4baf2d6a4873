"""Golden results for the reference's four inline record sets (FIXTURES B),
computed independently from the stated formulas."""

from pyspark.sql import functions as F

from tessera.operators.relational import groups_with_several, stable_rank_desc
from tessera.plans import scoring as SC

CANDIDATES = [  # ord, name, years, catalan, excel, studies
    (1, "c01", 6, 3, 3, 3), (2, "c02", 3, 3, 3, 2), (3, "c03", 3, 2, 2, 2), (4, "c04", 5, 7, 3, 2),
    (5, "c05", 2, 3, 2, 1), (6, "c06", 6, 3, 3, 3), (7, "c07", 5, 3, 3, 2), (8, "c08", 4, 3, 2, 2),
    (9, "c09", 2, 1, 1, 1), (10, "c10", 1, 2, 1, 0), (11, "c11", 1, 2, 1, 0), (12, "c12", 8, 2, 3, 3),
]


def test_candidates(spark):
    df = spark.createDataFrame(CANDIDATES, "ord int, nombre_completo string, `años_experiencia` int, "
                                           "catalan int, excel int, estudios int")
    scored, rejected = SC.score_candidates(df, max_candidates=11)
    assert [r.nombre_completo for r in rejected.collect()] == ["c04"]
    got = {r.nombre_completo: (r.puntuacion_total, r.clasificacion) for r in scored.collect()}
    assert got == {"c01": (18.0, "prioridad alta"), "c02": (12.5, "prioridad alta"),
                   "c03": (10.5, "candidato_adecuado"), "c05": (9.0, "candidato_adecuado"),
                   "c06": (18.0, "prioridad alta"), "c07": (15.5, "prioridad alta"),
                   "c08": (13.0, "prioridad alta"), "c09": (6.0, "no prioritario"),
                   "c10": (4.5, "no prioritario"), "c11": (4.5, "no prioritario")}
    order = [r.nombre_completo for r in stable_rank_desc(scored, "puntuacion_total", "ord").collect()]
    assert order == ["c01", "c06", "c07", "c08", "c02", "c03", "c05", "c09", "c10", "c11"]


def test_candidate_lookup_normalises(spark):
    df = spark.createDataFrame([(1, "  Laura Serra ", 6, 3, 3, 3)],
                               "ord int, nombre_completo string, `años_experiencia` int, "
                               "catalan int, excel int, estudios int")
    scored, _ = SC.score_candidates(df)
    assert SC.find_candidate(scored, "laura SERRA").count() == 1


CART = [(1, "18-25", 4), (2, "26-40", 3), (3, "26-40", 2), (4, "18-25", 2), (5, "41-60", 4),
        (6, "41-60", 1), (7, "60+", 3), (8, "26-40", 0), (9, "18-25", 1), (10, "26-40", 4)]


def test_cart_risk(spark):
    df = spark.createDataFrame(CART, "id_client int, grup_edat string, codi_comportament int")
    risk = SC.cart_risk(df)
    got = {r.id_client: r.risc_final for r in risk.collect()}
    assert got == {1: 1.08, 2: 0.75, 3: 0.50, 4: 0.60, 5: 0.77, 6: 0.21, 7: 0.52, 8: 0.10, 9: 0.30, 10: 0.90}
    ext = {r.question: r.id_client for r in SC.cart_extremes(risk).collect()}
    assert ext == {"highest_risk": 1, "lowest_risk": 8, "most_profitable": 1}
    assert sorted(r.id_client for r in SC.not_worth_investing(risk).collect()) == [6, 8, 9]
    several = {r.codi_comportament for r in groups_with_several(risk, "codi_comportament").collect()}
    assert several == {4, 3, 2, 1}


def test_triage(spark):
    recs = ["Maria|45|tos, Fiebre Alta, dolor_pecho", "Luis|33|dolor_cabeza,faTiga",
            "Sara|67|fiebre alta, dificultad RESPIRAR, tos", "Jordi|52|fatiga , tos",
            "Anna|29|fiebre alta,dolor_cabeza"]
    df = spark.createDataFrame(list(enumerate(recs, 1)), "ord int, record string")
    t = SC.triage(df)
    assert {r.ord: r.riesgo_total for r in t.collect()} == {1: 8, 2: 2, 3: 9, 4: 2, 5: 4}
    order = [r.ord for r in stable_rank_desc(t, "riesgo_total", "ord").collect()]
    assert order == [3, 1, 5, 2, 4]
    first = t.filter("ord = 1").first()
    assert first.nom == "Maria" and first.edad == "45" and first.sintomas == ["tos", "fiebre_alta", "dolor_pecho"]


def test_insurance(spark):
    df = spark.createDataFrame([(1, "i1", 42, 0), (2, "i2", 30, 2), (3, "i3", 55, 3), (4, "i4", 40, 1),
                                (5, "i5", 28, 0)], "ord int, nombre string, edad int, codigo int")
    p = SC.insurance_prices(df)
    got = {r.ord: round(r.precio_final, 2) for r in p.collect()}
    assert got == {1: 170.40, 2: 455.00, 3: 775.00, 4: 280.00, 5: 153.60}
    by_fraud = [r.ord for r in p.orderBy(F.desc("probabilidad_fraude"), "ord").collect()]
    by_price = [r.ord for r in p.orderBy(F.desc("precio_final"), "ord").collect()]
    assert by_fraud == [3, 2, 4, 1, 5] and by_price == [3, 2, 4, 1, 5]
    ans = {r.question: r.ord for r in SC.insurance_answers(p).collect()}
    assert ans == {"most_fraud": 3, "highest_price": 3, "review_first": 3}
