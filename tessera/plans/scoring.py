"""Rule-based scoring of tabular records (PIP22-PIP25).

Lookup tables are literal dimensions of a handful of rows (broadcast by
construction) or ``create_map`` literals; scores are column arithmetic; the
reports are sorts with an ordinal tie-break that reproduces Python's
stable ``sorted`` and first-wins ``max``/``min``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import normalise_items
from tessera.functions.rounding import py_round
from tessera.functions.text import normalise_key, split_list
from tessera.operators.ordinals import stable_rank

# ------------------------------------------------------------------ fixed values
# Candidate score bands (score >= 12, 8 <= score < 12, below 8).
BAND_HIGH, BAND_MID = 12, 8
BAND_LABELS = ("prioridad alta", "candidato_adecuado", "no prioritario")
EXPERIENCE_WEIGHT = 1.5

# Cart-abandonment behaviour codes: segment and behaviour factor.
BEHAVIOUR_CODES = {
    0: ("Navega pero no añade productos", 0.10),
    1: ("Añade productos pero no llega al checkout", 0.25),
    2: ("Llega al checkout pero no hace el pago", 0.50),
    3: ("Cesta de la compra abandonada hace menos de 24h", 0.75),
    4: ("Cesta de la compra abandonada hace más de 24h", 0.90),
}
AGE_GROUP_FACTORS = {"18-25": 1.20, "26-40": 1.0, "41-60": 0.85, "60+": 0.70}

# Symptom risk weights.
SYMPTOM_WEIGHTS = {"fiebre_alta": 3, "dificultad_respirar": 5, "dolor_pecho": 4,
                   "tos": 1, "fatiga": 1, "dolor_cabeza": 1}

# Insurance levels: category, base price, fraud probability.
INSURANCE_LEVELS = {
    0: ("Baix risc", 120, 0.01),
    1: ("Risc mitjà", 200, 0.05),
    2: ("Risc alt", 350, 0.15),
    3: ("Risc crític", 500, 0.30),
}


def _looked_up(d: dict, key: Column, value_index: int | None = None, strict: bool = False) -> Column:
    """JN13: the key's entry; a miss is NULL or, ``strict``, fails the job as ``dict[key]`` does."""
    value = F.try_element_at(_map(d, value_index), key)
    if not strict:
        return value
    missing = F.raise_error(F.concat(F.lit("unmapped key: "), F.coalesce(key.cast("string"), F.lit("NULL"))))
    return F.when(value.isNull(), missing).otherwise(value)


def _map(d: dict, value_index: int | None = None) -> Column:
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v if value_index is None else v[value_index])]
    return F.create_map(*kv)


# ------------------------------------------------------------------ PIP22
def score_candidates(df: DataFrame, max_candidates: int | None = None, ord_col: str = "ord"
                     ) -> tuple[DataFrame, DataFrame]:
    """PIP22: normalise names, (optionally) keep the first ``max_candidates``
    by ordinal, validate skill levels 0..3, score, band.

    Returns ``(scored, rejected)``; rejected rows are the quarantine the
    reference printed.  Report order: ``stable_rank_desc(scored, 'puntuacion_total', ord)``.
    """
    d = df.withColumn("nombre_completo", normalise_key(F.col("nombre_completo")))
    if max_candidates is not None:  # the list slice precedes validation
        d = d.orderBy(ord_col).limit(max_candidates)
    ok = F.col("catalan").between(0, 3) & F.col("excel").between(0, 3) & F.col("estudios").between(0, 3)
    ok = F.coalesce(ok, F.lit(False))
    score = F.col("años_experiencia") * EXPERIENCE_WEIGHT + F.col("catalan") + F.col("excel") + F.col("estudios")
    scored = d.filter(ok).withColumn("puntuacion_total", score.cast("double")).withColumn(
        "clasificacion",
        F.when(F.col("puntuacion_total") >= BAND_HIGH, F.lit(BAND_LABELS[0]))
        .when(F.col("puntuacion_total") >= BAND_MID, F.lit(BAND_LABELS[1]))
        .otherwise(F.lit(BAND_LABELS[2])))
    return scored, d.filter(~ok)


def candidate_report(scored: DataFrame, ord_col: str = "ord") -> DataFrame:
    """PIP22/SRT5: the scored candidates with their ``rank``, best first, ties in input order."""
    return stable_rank(scored, "puntuacion_total", ord_col)


def find_candidate(scored: DataFrame, name: str) -> DataFrame:
    """FLT13: exact lookup after normalising the typed name."""
    return scored.filter(F.col("nombre_completo") == normalise_key(F.lit(name)))


# ------------------------------------------------------------------ PIP23
def cart_risk(clients: DataFrame, strict: bool = False) -> DataFrame:
    """PIP23: segment + code factor × age factor → ``risc_final`` (2 dp, rounded as Python does).

    Unknown codes/age groups give NULL; ``strict`` fails on the first one.
    """
    code = F.col("codi_comportament")
    return clients.withColumns({
        "segment": _looked_up(BEHAVIOUR_CODES, code, 0, strict),
        "factor_codi": _looked_up(BEHAVIOUR_CODES, code, 1, strict),
        "factor_edad": _looked_up(AGE_GROUP_FACTORS, F.col("grup_edat"), None, strict),
    }).withColumn("risc_final", py_round(F.col("factor_codi") * F.col("factor_edad"), 2))


def _answers(df: DataFrame, firsts: dict[str, Column]) -> DataFrame:
    """(question, fields of the answer) of several one-row answers, all from one aggregate."""
    one = df.agg(*[a.alias(f"_{i}") for i, a in enumerate(firsts.values())])
    rows = F.array(*[F.struct(F.lit(q).alias("question"), F.col(f"_{i}").alias("answer")) for i, q in enumerate(firsts)])
    return one.select(F.explode(rows).alias("r")).where("r.answer is not null").select("r.question", "r.answer.*")


def _first(row: Column, score: Column, ord_col: str, lowest: bool = False, where: Column | None = None) -> Column:
    """AGG21: the row of the greatest (lowest) score, first in input order on ties; NULL scores come last."""
    order = F.struct(score if lowest else -score, F.col(ord_col))
    keep = score.isNotNull() if where is None else score.isNotNull() & where
    return F.min_by(F.when(keep, row), F.when(keep, order))


def cart_extremes(risk: DataFrame, ord_col: str = "id_client") -> DataFrame:
    """PIP23 answers 1, 4 and the lowest: ``(question, id_client, risc_final)``, one aggregate,
    first on ties by ordinal as Python's ``max``/``min``."""
    score, row = F.col("risc_final"), F.struct(F.col(ord_col).alias("id_client"), "risc_final")
    return _answers(risk, {
        "highest_risk": _first(row, score, ord_col),
        "lowest_risk": _first(row, score, ord_col, lowest=True),
        "most_profitable": _first(row, score, ord_col, where=F.col("codi_comportament") >= 3)})


def not_worth_investing(risk: DataFrame, max_code: int = 1) -> DataFrame:
    """PIP23 answer 3: clients whose code is at most ``max_code``."""
    return risk.filter(F.col("codi_comportament") <= max_code)


# ------------------------------------------------------------------ PIP24
def parse_patient(record: Column) -> Column:
    """CLN15: ``'name|age|sym, sym'`` → struct(nom, edad (text), sintomas)."""
    parts = split_list(record, "|")
    syms = normalise_items(split_list(parts.getItem(2), ","))
    return F.struct(parts.getItem(0).alias("nom"), parts.getItem(1).alias("edad"),
                    syms.alias("sintomas"))


def triage(records: DataFrame, record_col: str = "record", strict: bool = False) -> DataFrame:
    """PIP24: parse, normalise and weigh (sum over the record's own symptom list
    — AGG22 with ``aggregate`` over a short array).  An unknown symptom makes
    the sum NULL or, ``strict``, fails the job."""
    p = records.withColumn("_p", parse_patient(F.col(record_col))).select("*", "_p.*").drop("_p")
    total = F.aggregate(F.col("sintomas"), F.lit(0).cast("bigint"),
                        lambda acc, s: acc + _looked_up(SYMPTOM_WEIGHTS, s, None, strict).cast("bigint"))
    return p.withColumn("riesgo_total", total)


def triage_report(records: DataFrame, ord_col: str = "ord") -> DataFrame:
    """PIP24/SRT5: every patient with their ``rank`` by risk, ties in input order; an unknown symptom fails."""
    return stable_rank(triage(records, strict=True), "riesgo_total", ord_col)


# ------------------------------------------------------------------ PIP25
def insurance_prices(clients: DataFrame) -> DataFrame:
    """PIP25: category, base price, fraud probability and
    ``precio_final = precio_base * (1 + edad / 100)``."""
    code = F.col("codigo")
    return clients.withColumns({
        "categoria": F.element_at(_map(INSURANCE_LEVELS, 0), code),
        "precio_base": F.element_at(_map(INSURANCE_LEVELS, 1), code),
        "probabilidad_fraude": F.element_at(_map(INSURANCE_LEVELS, 2), code),
    }).withColumn("precio_final", F.col("precio_base") * (1 + F.col("edad") / 100))


def insurance_ranking(priced: DataFrame, by: str, ord_col: str = "ord") -> DataFrame:
    """PIP25/SRT5: every client with their ``rank`` by ``probabilidad_fraude`` or ``precio_final``, highest first."""
    return stable_rank(priced, by, ord_col)


def insurance_answers(priced: DataFrame, ord_col: str = "ord") -> DataFrame:
    """PIP25: first of each ranking (fraud desc, price desc) and the manual
    review pick (= first by fraud), as ``(question, nombre, ord)``, one aggregate."""
    row = F.struct("nombre", F.col(ord_col).alias("ord"))
    fraud = _first(row, F.col("probabilidad_fraude"), ord_col)
    return _answers(priced, {"most_fraud": fraud, "highest_price": _first(row, F.col("precio_final"), ord_col),
                             "review_first": fraud})
