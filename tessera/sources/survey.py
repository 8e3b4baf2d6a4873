"""Employee-survey inputs derived from the driver tables.

The survey sheet is all text with the defects the cleaning pipeline repairs:
key conflicts and resubmissions, mojibake, salary text in several formats
(euro sign, the word euros, decimal comma, hundreds instead of units,
garbage), gender codes, inconsistent children/car fields, missing values
and impossible birth dates.  Built from ``customer`` (+ nation/region) with
deterministic rules on the key, so DuckDB can build the identical table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import MOJIBAKE_FIXES
from tessera.sources.tables import Tables

# Survey header as it appears in the sheet (after header promotion).
SHEET_COLUMNS = ("Nom", "Cognoms", "DNI", "País d'origen", "Ciutat", "Dia de Naixement",
                 "Mes de Naixement", "Any de Naixement", "Gènere", "Salari mensual", "Fills",
                 "No Fills", "Grup Professional", "Nombre_fills", "Te_cotxe", "Km_anuals",
                 "Consum_mitja_L_100km", "Temperatura_mitjana_ciutat")

GENDER_CODES = ("D", "d", "H", "h", "F", "M", "NC", "A")  # index 8 → missing


def _m(k: Column, n: int) -> Column:
    return F.pmod(k, F.lit(n))


def _s(c: Column) -> Column:
    return c.cast("string")


def survey_sheet(t: Tables) -> DataFrame:
    """The raw sheet: ``_ord`` (row order) + the text columns above.

    Customers with ``key % 97 == 5`` reuse the previous key's DNI (a
    different person: conflict); customers with ``key % 89 == 3`` are
    submitted twice (the copy right after the original).
    """
    c = t.customer
    n, r = t.nation, t.region
    base = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    # one scan: a resubmitted customer yields two rows (copy right after)
    copies = F.when(_m(F.col("c_custkey"), 89) == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = base.select("*", F.explode(copies).alias("_copy")) \
        .withColumn("_ord", F.col("c_custkey") * 2 + F.col("_copy"))
    k = F.col("c_custkey")
    dni_num = F.when(_m(k, 97) == 5, k - 1).otherwise(k)
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    euros = F.floor(cents / 100).cast("bigint")
    cc = F.lpad(_s(_m(cents, 100)), 2, "0")
    fmt = _m(k, 6)
    salary = (F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
              .when(fmt == 0, F.concat(_s(euros), F.lit("."), cc, F.lit("€")))
              .when(fmt == 1, F.concat(_s(euros), F.lit(","), cc))
              .when(fmt == 2, F.concat(_s(euros), F.lit("."), cc, F.lit(" Euros")))
              .when(fmt == 3, F.concat(_s(euros), F.lit("."), cc))
              .when((fmt == 4) & (euros >= 100),
                    F.concat(_s(F.floor(euros / 100).cast("bigint")), F.lit("."),
                             F.lpad(_s(_m(euros, 100)), 2, "0")))
              .when(fmt == 4, _s(euros))
              .otherwise(F.lit("euros")))
    gender = F.try_element_at(F.array(*[F.lit(g) for g in GENDER_CODES]), (_m(k, 9) + 1).cast("int"))
    tf = lambda cond_true, cond_false: F.when(cond_true, F.lit("True")).when(cond_false, F.lit("False"))
    # every damaged sequence of the repair table occurs, one per name
    damaged = F.element_at(F.array(*[F.lit(f"n{bad}z") for bad, _ in MOJIBAKE_FIXES]), (_m(k, len(MOJIBAKE_FIXES)) + 1).cast("int"))
    return rows.select(
        "_ord",
        F.when(_m(k, 11) == 3, F.concat(F.col("c_name"), F.lit(" "), damaged)).otherwise(F.col("c_name")).alias("Nom"),
        F.concat(F.lit("Cognom"), _s(_m(k, 97))).alias("Cognoms"),
        F.concat(F.lpad(_s(dni_num), 8, "0"), F.lit("K")).alias("DNI"),
        F.col("r_name").alias("País d'origen"),
        F.col("n_name").alias("Ciutat"),
        _s(_m(k, 31) + 1).alias("Dia de Naixement"),
        _s(_m(k * 5, 12) + 1).alias("Mes de Naixement"),
        F.when(_m(k, 50) == 7, F.lit(None).cast("string"))
        .otherwise(_s(_m(k * 3, 55) + 1950)).alias("Any de Naixement"),
        gender.alias("Gènere"),
        salary.alias("Salari mensual"),
        tf(_m(k, 5).isin(0, 3), _m(k, 5).isin(1, 4)).alias("Fills"),
        tf(_m(k, 7) == 0, _m(k, 7) == 1).alias("No Fills"),
        F.when(_m(k, 37) == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("Grup Professional"),
        F.when(_m(k, 3) == 0, F.lit(None).cast("string")).otherwise(_s(_m(k, 4))).alias("Nombre_fills"),
        tf(_m(k, 4) == 0, _m(k, 4) == 1).alias("Te_cotxe"),
        F.when(_m(k, 6) == 1, F.lit(None).cast("string")).otherwise(_s(_m(k * 37, 40001))).alias("Km_anuals"),
        F.when(_m(k, 8) == 2, F.lit(None).cast("string")).otherwise(_s(_m(k, 9) + 3)).alias("Consum_mitja_L_100km"),
        F.when(_m(k, 13) == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(_s(_m(k, 15) + 5), F.lit("."), _s(_m(k, 10)))).alias("Temperatura_mitjana_ciutat"),
    )


def city_context(t: Tables) -> DataFrame:
    """City context table: one row per nation except ``key % 6 == 5``
    (those cities stay unmatched after the merge, as in the reference)."""
    n, r = t.nation, t.region
    k = F.col("n_nationkey")
    return n.join(r, n.n_regionkey == r.r_regionkey).filter(_m(k, 6) != 5).select(
        F.col("n_name").alias("Ciutat"), F.col("r_name").alias("País"),
        (F.lit(50) + _m(k * 13, 50)).cast("double").alias("Cost_vida_index"),
        _m(k * 7, 10).cast("double").alias("Transport_public_score"))


#: The sheet as delivered: a blank first column, a column whose name is damaged, and a repeated one.
RAW_NAMES = ("", *SHEET_COLUMNS[:13], "CÃ rrec", *SHEET_COLUMNS[13:], "Nom")
HEADER_ROW = 2


def raw_sheet(t: Tables) -> DataFrame:
    """``_place`` and text columns ``c0..``: two leading rows, the header, the rows, and an empty row after every 50th."""
    sheet = survey_sheet(t)
    n = len(RAW_NAMES)
    values = {name: F.col(f"`{name}`") for name in SHEET_COLUMNS}
    values |= {"": F.lit(None).cast("string"), "CÃ rrec": F.concat(F.lit("Nivell "), _s(_m(F.col("_ord"), 4)))}
    body = sheet.select((F.col("_ord") * 2 + 10).alias("_place"), *[values[name].alias(f"c{i}") for i, name in enumerate(RAW_NAMES)])
    empty = body.where(_m(F.col("_place"), 50) == 0).select(
        (F.col("_place") + 1).alias("_place"), *[F.lit(None).cast("string").alias(f"c{i}") for i in range(n)])
    lead = [(0, "Enquesta", *[None] * (n - 1)), (1, None, "any", *[None] * (n - 2)), (2, *[name or None for name in RAW_NAMES])]
    head = t.spark.createDataFrame(lead, "_place bigint, " + ", ".join(f"c{i} string" for i in range(n)))
    return head.unionByName(body).unionByName(empty)


def write_raw_sheet(t: Tables, path: str, files: int = 4) -> str:
    """The sheet as several headerless CSV files, whose names sort as their rows do."""
    raw = raw_sheet(t)
    (raw.repartitionByRange(files, "_place").sortWithinPartitions("_place").drop("_place")
     .write.option("header", False).csv(path))
    return path
