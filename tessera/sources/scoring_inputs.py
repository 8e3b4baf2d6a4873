"""Record sets for the scoring plans, derived from the driver tables.

| plan       | records                                   | rule                                   |
| ---------- | ----------------------------------------- | -------------------------------------- |
| candidates | one per customer                          | skills from key/nation residues        |
| cart risk  | one per events user                       | code of the user's latest event type   |
| triage     | one text record per event                 | ``user_<id>|<age>|<symptoms>``         |
| insurance  | one per customer                          | age and level code from the key        |
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.tables import Tables

# Fixed values of this library: event type → behaviour code, and the
# symptom text each event type stands for in triage records (mixed case and
# blanks on purpose, normalised by the plan).
EVENT_CODE = {"view": 0, "click": 1, "signup": 2, "purchase": 3, "error": 4}
EVENT_SYMPTOM = {"view": "tos", "click": " Fatiga", "signup": "dolor cabeza ",
                 "error": "Fiebre Alta", "purchase": "dificultad RESPIRAR"}
AGE_GROUPS = ("18-25", "26-40", "41-60", "60+")


def _map(d):
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def candidates(t: Tables) -> DataFrame:
    c = t.customer
    k = c.c_custkey
    return c.select(
        k.alias("ord"),
        F.when(F.pmod(k, F.lit(5)) == 0, F.concat(F.lit("  "), c.c_name)).otherwise(c.c_name).alias("nombre_completo"),
        F.concat(F.lit("6"), F.lpad(k.cast("string"), 8, "0")).alias("telefono"),
        F.pmod(k, F.lit(10)).cast("int").alias("años_experiencia"),
        F.pmod(c.c_nationkey, F.lit(5)).cast("int").alias("catalan"),
        F.pmod(k, F.lit(4)).cast("int").alias("excel"),
        F.pmod(k * 3, F.lit(4)).cast("int").alias("estudios"))


def cart_clients(t: Tables) -> DataFrame:
    """One client per events user; its code is that of the latest event
    (``max_by`` is a partial aggregate: a hot user is reduced per task)."""
    e = t.events
    last = e.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("_t"))
    u = F.col("user_id")
    return last.select(
        u.alias("id_client"),
        F.concat(F.lit("user_"), u.cast("string")).alias("nom"),
        (F.lit(18) + F.pmod(u * 7, F.lit(60))).cast("int").alias("edat"),
        F.element_at(F.array(*[F.lit(g) for g in AGE_GROUPS]), (F.pmod(u, F.lit(4)) + 1).cast("int")).alias("grup_edat"),
        F.element_at(_map(EVENT_CODE), F.col("_t")).cast("int").alias("codi_comportament"))


def triage_records(t: Tables) -> DataFrame:
    e = t.events
    u = e.user_id
    sym = F.element_at(_map(EVENT_SYMPTOM), e.event_type)
    rec = F.concat(F.lit("user_"), u.cast("string"), F.lit("|"),
                   (F.lit(18) + F.pmod(u * 7, F.lit(60))).cast("string"), F.lit("|"), sym,
                   F.when(e.value > 15, F.lit(", dolor_pecho")).otherwise(F.lit("")))
    return e.select(e.event_id.alias("ord"), rec.alias("record"))


def insurance_clients(t: Tables) -> DataFrame:
    c = t.customer
    k = c.c_custkey
    return c.select(k.alias("ord"), c.c_name.alias("nombre"),
                    (F.lit(18) + F.pmod(k * 7, F.lit(60))).cast("int").alias("edad"),
                    F.pmod(k, F.lit(4)).cast("int").alias("codigo"))
