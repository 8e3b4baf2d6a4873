"""Registered queries on files, table maintenance, checked writes and first looks (SRC*, SNK*, MUT*, DQ*, CLN1-CLN4).

Loaded by ``plans.registry``, whose helpers it shares.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import clean as C
from tessera.operators import mutate as MU
from tessera.operators import profile as P
from tessera.operators import quality as Q
from tessera.operators import relational as RL
from tessera.operators import reshape as RS
from tessera.operators.keyed_table import KeyedTable
from tessera.operators.key_bitmaps import has_key, key_bitmaps
from tessera.operators.ordinals import with_ordinal
from tessera.operators.routes import edges_from_matrix
from tessera.plans import employees as E
from tessera.plans import oracle_model as M
from tessera.plans import oracle_survey as S
from tessera.plans.registry import _CLEAN_COLS, _PRICED, _PRICED_COLS, _V, _clean, _t, query
from tessera.session import scratch_dir
from tessera.sinks import checked as K
from tessera.sinks import writers as W
from tessera.sources import files as FI
from tessera.sources import retail as src
from tessera.sources import survey as SV
from tessera.sources.quarantine import read_with_ordinal, read_with_rejects

# ------------------------------------------------------------------ SRC8, CLN1-CLN4, SET3, PIP26
_RAW_COLS = [c.strip() for c in _CLEAN_COLS.split(",") if c.strip() != "_ord"]


@query("employees_from_raw_sheet", "WITH " + S.CLEAN + f"""
SELECT {", ".join(_RAW_COLS)}, 'Nivell ' || _ord % 4 AS carrec FROM clean""")
def q_raw_sheet(spark, d):
    """The sheet as delivered: several files, leading rows, blank and repeated columns, a damaged name, empty rows."""
    path = SV.write_raw_sheet(_t(spark, d), scratch_dir(spark, "raw_sheet"))
    raw = read_with_ordinal(spark, path, len(SV.RAW_NAMES))
    return E.clean_raw_employees(raw, SV.HEADER_ROW)[0].select(*_RAW_COLS, F.col("càrrec").alias("carrec"))


@query("raw_sheet_rows", "WITH " + S.SHEET + """,
places AS (SELECT _ord * 2 + 10 AS place, "DNI" AS dni FROM sheet UNION ALL SELECT _ord * 2 + 11, NULL FROM sheet WHERE (_ord * 2 + 10) % 50 = 0)
SELECT row_number() OVER (ORDER BY place) + 2 AS ordinal, dni FROM places""")
def q_raw_rows(spark, d):
    """CLN1: the place of every row over all files, below the header."""
    path = SV.write_raw_sheet(_t(spark, d), scratch_dir(spark, "raw_sheet"))
    raw = read_with_ordinal(spark, path, len(SV.RAW_NAMES), "ordinal")
    at = SV.RAW_NAMES.index("DNI")
    return raw.where(F.col("ordinal") > SV.HEADER_ROW).select("ordinal", F.col(f"_c{at}").alias("dni"))


# ------------------------------------------------------------------ SRC1-SRC3, SRC5-SRC7, SRC9
_PART = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("price", T.DoubleType())])
#: Layout: how it is written and read.
_LAYOUTS = {
    "comma": {"sep": ","},
    "quoted": {"sep": ",", "line_sep": "\n"},
    "semicolon": {"sep": ";"},
    "latin1": {"sep": ",", "encoding": "ISO-8859-1"},
}


def _parts(spark, d):
    """Parts as text; one price in fifty cannot be read."""
    p = _t(spark, d).part
    price = F.when(F.pmod("p_partkey", F.lit(50)) == 7, F.lit("n/a")).otherwise(F.col("p_retailprice").cast("string"))
    return p.select(F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit("peça, "), F.col("p_name")).alias("name"), price.alias("price"))


@query("delimited_layouts", "WITH parts AS (SELECT p_partkey, 'peça, ' || p_name AS name, p_retailprice AS price, p_partkey % 50 = 7 AS bad FROM part),"
       + " layouts(layout, sep) AS (VALUES " + ", ".join(f"('{n}', '{o['sep']}')" for n, o in _LAYOUTS.items()) + """)
SELECT layout, 'row' AS kind, p_partkey AS id, name, price, NULL::VARCHAR AS line FROM parts, layouts WHERE NOT bad
UNION ALL SELECT layout, 'reject', NULL, NULL, NULL, p_partkey || sep || CASE WHEN sep = ',' THEN '"' || name || '"' ELSE name END || sep || 'n/a'
FROM parts, layouts WHERE bad""")
def q_layouts(spark, d):
    """Every layout written from the parts in several files, read back as typed rows and rejected lines."""
    out = None
    for name, options in _LAYOUTS.items():
        path = scratch_dir(spark, f"layout_{name}")
        writer = _parts(spark, d).repartition(3).write.option("header", True).option("sep", options["sep"])
        if "encoding" in options:
            writer = writer.option("encoding", options["encoding"])
        writer.csv(path)
        rows, rejects = read_with_rejects(spark, path, _PART, **options)
        both = rows.select(F.lit("row").alias("kind"), "id", "name", "price", F.lit(None).cast("string").alias("line")).unionByName(
            rejects.select(F.lit("reject").alias("kind"), F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("name"),
                           F.lit(None).cast("double").alias("price"), F.col("_line").alias("line")))
        both = both.withColumn("layout", F.lit(name))
        out = both if out is None else out.unionByName(both)
    return out.select("layout", "kind", "id", "name", "price", "line")


@query("inferred_and_text_schemas", """SELECT 'inferred' AS layout, c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT 'text', c_custkey, c_name, c_acctbal FROM customer""")
def q_schemas(spark, d):
    """SRC5 and SRC6: the same files with an inferred schema, and as text that silver casts."""
    path = scratch_dir(spark, "schemas")
    _t(spark, d).customer.select("c_custkey", "c_name", "c_acctbal").repartition(2).write.option("header", True).csv(path)
    inferred = FI.read_delimited(spark, path, infer_schema=True)
    text = FI.read_delimited(spark, path, schema=FI.all_string_schema(["c_custkey", "c_name", "c_acctbal"]))
    return inferred.select(F.lit("inferred").alias("layout"), F.col("c_custkey").cast("bigint").alias("id"), F.col("c_name").alias("name"),
                           F.col("c_acctbal").alias("balance")).unionByName(
        text.select(F.lit("text").alias("layout"), F.col("c_custkey").try_cast("bigint").alias("id"), F.col("c_name").alias("name"),
                    F.col("c_acctbal").try_cast("double").alias("balance")))


@query("cards_from_file", """SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey AS INTEGER) AS user_id,
 make_date(CASE WHEN (c_custkey * 7) % 100 < 70 THEN 2000 ELSE 1900 END + CAST((c_custkey * 7) % 100 AS INTEGER),
   CAST(c_custkey % 12 + 1 AS INTEGER), CAST(c_custkey % 28 + 1 AS INTEGER)) AS expiring_date FROM customer""")
def q_cards_file(spark, d):
    """SRC4: the card file, its short dates read while it is loaded."""
    k, path = F.col("c_custkey"), scratch_dir(spark, "cards")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    expiry = F.concat_ws("/", two(F.pmod(k, F.lit(12)) + 1), two(F.pmod(k, F.lit(28)) + 1), two(F.pmod(k * 7, F.lit(100))))
    blank = [F.lit("x").alias(c) for c in ("iban", "pan", "pin", "cvv", "track1", "track2")]
    _t(spark, d).customer.select(k.alias("id"), k.alias("user_id"), *blank, expiry.alias("expiring_date")).write.option("header", True).csv(path)
    return FI.read_cards_csv(spark, path).select("id", "user_id", "expiring_date")


# ------------------------------------------------------------------ SRC10, MAP1
@query("salary_policy_document", _PRICED + f"SELECT {_PRICED_COLS} FROM priced")
def q_policy_document(spark, d):
    """PIP28 with the rules of a JSON document, read as VARIANT; no figure passes through the driver."""
    path = scratch_dir(spark, "policy")
    spark.createDataFrame([(json.dumps(E.DEFAULT_POLICY, indent=1),)], "value string").coalesce(1).write.text(path)
    enriched = E.enrich_with_city(_clean(spark, d), SV.city_context(_t(spark, d)))
    return E.apply_salary_policy(enriched, FI.read_policy(spark, path)).select(*[c.strip().strip('"') for c in _PRICED_COLS.split(",")])


# ------------------------------------------------------------------ SRC13, RSH2, RSH4
_KM = "(50 + ((least(a, b) + 1) * (greatest(a, b) + 1) * 37 + (a + b) * 11) % 997)"
_LANE_SQL = f"""lanes AS (SELECT DISTINCT c_nationkey AS a, s_nationkey AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
named AS (SELECT x.n_name AS src, y.n_name AS dst, CASE WHEN a = b THEN 0.0 ELSE {_KM} END::DOUBLE AS km
  FROM lanes JOIN nation x ON a = x.n_nationkey JOIN nation y ON b = y.n_nationkey)"""


@query("distance_matrix_edges", f"""WITH {_LANE_SQL}, cities AS (SELECT n_name AS c FROM nation WHERE n_name NOT IN ('NATION_23', 'NATION_24')),
places AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS ord FROM cities)
SELECT s.c AS src, p.c AS dst, km, p.ord::INTEGER AS ord FROM cities s CROSS JOIN places p LEFT JOIN named ON src = s.c AND dst = p.c
WHERE s.c IN (SELECT src FROM named)""")
def q_matrix(spark, d):
    """The lanes as a square matrix file (one column per city), read back and turned into edges."""
    from tessera.sources.lanes import ISLANDS, lane_edges
    t, path = _t(spark, d), scratch_dir(spark, "matrix")
    names = [r[0] for r in t.nation.select("n_name").distinct().orderBy("n_name").collect()]  # the matrix's own columns
    wide = RS.pivot_mean(lane_edges(t), "src", "dst", "km", names).withColumnRenamed("src", "ciutat")
    wide.coalesce(1).write.option("header", True).csv(path)
    return edges_from_matrix(FI.read_distance_matrix(spark, path), exclude=list(ISLANDS))


# ------------------------------------------------------------------ MUT1-MUT7, SNK5
@query("keyed_maintenance", """WITH first AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer),
edited AS (SELECT id, CASE WHEN id % 10 = 4 THEN NULL ELSE name END AS name, CASE WHEN id % 10 = 3 THEN balance + 1000 WHEN id % 10 = 4 THEN 0 ELSE balance END AS balance
  FROM first WHERE id % 10 <> 7),
added AS (SELECT * FROM edited UNION ALL SELECT -1 - s_suppkey, s_name, NULL FROM supplier)
SELECT id, CASE WHEN id = -2 THEN 'renamed' ELSE name END AS name, balance FROM added WHERE id <> -1""")
def q_keyed(spark, d):
    """Inserts, updates and deletes by key: one set over many buckets, then one that touches two rows."""
    t = _t(spark, d)
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    table = KeyedTable.create(c, scratch_dir(spark, "keyed"), "id", buckets=16)
    last = F.pmod("id", F.lit(10))
    op = F.when(last.isin(3, 4), "update").when(last == 7, "delete")
    edits = c.select("id", op.alias("op"), F.when(last == 3, F.col("name")).alias("name"),
                     F.when(last == 3, F.col("balance") + 1000).otherwise(F.lit(0.0)).alias("balance")).where("op is not null")
    table.apply(edits)
    table.apply(t.supplier.select((-1 - F.col("s_suppkey")).alias("id"), F.lit("insert").alias("op"), F.col("s_name").alias("name")))
    few = t.supplier.where("s_suppkey <= 1").select((-1 - F.col("s_suppkey")).alias("id"), F.when(F.col("s_suppkey") == 0, "delete").otherwise("update").alias("op"),
                                                   F.lit("renamed").alias("name"))
    table.apply(few)
    return table.read()


@query("company_columns", _V(c=M.COMPANIES) + """
SELECT company_id AS id, company_name, country, CASE WHEN country IN ('United States', 'Canada') THEN 'America' ELSE 'Europe' END AS continent,
 NULL::VARCHAR AS website FROM c UNION ALL SELECT 0, 'New company', NULL, 'Europe', NULL""")
def q_company_columns(spark, d):
    """MUT1, MUT3, MUT5-MUT7: a row added, a column added and set by CASE, columns dropped and renamed."""
    c = MU.drop_columns(src.companies(_t(spark, d)), ["phone", "email", "continent", "no such column"])
    c = MU.insert_rows(c, spark.createDataFrame([(0, "New company")], "company_id bigint, company_name string"))
    c = MU.set_column_case(MU.add_column(c, "continent", "string"), "continent", MU.continent_of(F.col("country")))
    return MU.rename_columns(MU.add_column(c, "website", "string"), {"company_id": "id"})


# ------------------------------------------------------------------ SNK1, SNK3, SNK5
@query("table_and_view", _V(t=M.TRANSACTIONS) + """
SELECT business_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM t WHERE NOT declined GROUP BY business_id""")
def q_table_view(spark, d):
    """A table replaced, a view on it, and SQL on the view."""
    path = scratch_dir(spark, "replaced")
    t = src.transactions(_t(spark, d), False)
    W.replace_table(t.limit(0), path)
    W.replace_table(t, path)
    name = W.view(spark.read.parquet(path).where("not declined"), "accepted_transactions")
    return spark.sql(f"SELECT business_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM {name} GROUP BY business_id")


# ------------------------------------------------------------------ DQ1-DQ4 at write time
@query("checked_fact_write", _V(t=M.TRANSACTIONS, u=M.USERS) + """
, m AS (SELECT count(*) AS n FROM t WHERE user_id IN (SELECT user_id FROM u))
SELECT 'version' AS metric, 1::BIGINT AS value UNION ALL SELECT 'rows', n FROM m UNION ALL SELECT 'published_rows', n FROM m
UNION ALL SELECT unnest(['null_transaction_id', 'null_amount', 'null_declined', 'orphan_user_id', 'range_amount']), 0""")
def q_checked(spark, d):
    """Transactions of known users, written and checked in one pass; the second, unchecked-for users, is refused."""
    t = _t(spark, d)
    maps = key_bitmaps(src.users(t), ["user_id"]).select("bucket", "bits")
    tx = src.transactions(t, False)
    tx = tx.join(maps, F.bitmap_bucket_number("user_id") == F.col("bucket"), "left").withColumn("_known", has_key(F.col("bits"), F.col("user_id")))
    checks = {**K.not_null("transaction_id", "amount", "declined"), **K.without_parent({"user_id": F.col("_known")}),
              **K.in_range("amount", 0, 10_000_000)}
    root, drop = scratch_dir(spark, "checked"), ("bucket", "bits", "_known")
    done = K.write_checked(tx.where("_known"), root, checks, drop)
    try:
        K.write_checked(tx, root, checks, drop)
        raise AssertionError("transactions of unknown users were published")
    except K.ChecksFailedError:
        pass
    now = K.read_published(spark, root).agg(F.count("*").alias("value")).select(F.lit("published_rows").alias("metric"), "value")
    counts = [("version", done.version), *done.metrics.items()]
    return spark.createDataFrame(counts, "metric string, value bigint").unionByName(now)


# ------------------------------------------------------------------ first looks: AGG16-AGG18, AGG20, PRF2, PRF3, SRT4, SRT6, SRT7, FLT4, FLT8
@query("rows_before_and_after", "WITH " + S.CLEAN + """
SELECT 'rows' AS metric, count(*) AS value FROM clean UNION ALL SELECT 'columns', 15 UNION ALL SELECT 'rows_before', count(*) FROM sheet""")
def q_shape(spark, d):
    return P.shape_report(_clean(spark, d), SV.survey_sheet(_t(spark, d)))


@query("first_look", "WITH " + S.CLEAN + """, first_rows AS (SELECT * FROM clean ORDER BY _ord LIMIT 5)
SELECT 'sample' AS part, CAST(_ord AS VARCHAR) AS "column", 'nom' AS stat, NULL::DOUBLE AS value, nom AS text FROM first_rows
UNION ALL SELECT 'describe', "column", stat, value, text FROM (""" + """
  SELECT 'salari_mensual' AS "column", unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS stat,
  unnest([count(salari_mensual)::DOUBLE, round(avg(salari_mensual), 4), round(stddev(salari_mensual), 4), min(salari_mensual),
    round(quantile_cont(salari_mensual, 0.25), 4), round(quantile_cont(salari_mensual, 0.5), 4), round(quantile_cont(salari_mensual, 0.75), 4),
    max(salari_mensual)]) AS value, NULL::VARCHAR AS text FROM clean)""")
def q_first_look(spark, d):
    """PRF2: the first rows and the description of a column in one report."""
    clean = _clean(spark, d)
    sample = P.sample_rows(clean, "_ord", 5).select(F.lit("sample").alias("part"), F.col("_ord").cast("string").alias("column"), F.lit("nom").alias("stat"),
                                                    F.lit(None).cast("double").alias("value"), F.col("nom").alias("text"))
    described = P.describe(clean, ["salari_mensual"]).select(F.lit("describe").alias("part"), "column", "stat", F.round("value", 4).alias("value"), "text")
    return sample.unionByName(described)


@query("null_and_infinite", _PRICED + """
, x AS (SELECT salari_mensual, CASE WHEN temperatura_mitjana_ciutat = 12.5 THEN 'inf'::DOUBLE ELSE temperatura_mitjana_ciutat END AS temperatura, edad FROM priced)
SELECT 'salari_mensual' AS "column", count(*) - count(salari_mensual) AS nulls, count(*) FILTER (WHERE isinf(salari_mensual)) AS infinite FROM x
UNION ALL SELECT 'temperatura', count(*) - count(temperatura), count(*) FILTER (WHERE isinf(temperatura)) FROM x
UNION ALL SELECT 'edad', count(*) - count(edad), 0 FROM x""")
def q_infinite(spark, d):
    """PRF3: NULL and infinite counts of every column."""
    priced = E.apply_salary_policy(E.enrich_with_city(_clean(spark, d), SV.city_context(_t(spark, d))))
    heat = F.col("temperatura_mitjana_ciutat")
    x = priced.select("salari_mensual", F.when(heat == 12.5, float("inf")).otherwise(heat).alias("temperatura"), "edad")
    return P.null_counts(x, only_positive=False, with_infinite=True)


@query("sheet_filters", "WITH " + S.SHEET + """
SELECT 'not in, NULL kept' AS question, _ord FROM sheet WHERE "Gènere" IS NULL OR "Gènere" NOT IN ('D', 'd', 'H', 'h')
UNION ALL SELECT 'contains', _ord FROM sheet WHERE lower("Ciutat") LIKE '%nation_1%'
UNION ALL SELECT 'repeated key', _ord FROM sheet WHERE "DNI" IN (SELECT "DNI" FROM sheet GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'answered and unknown', _ord FROM sheet WHERE "Fills" = 'True' AND "Nombre_fills" IS NULL""")
def q_filters(spark, d):
    """FLT4, FLT8, FLT10, SRT6 on the sheet."""
    sheet = SV.survey_sheet(_t(spark, d))
    found = {"not in, NULL kept": sheet.where(C.not_in_keep_null(F.col("Gènere"), ["D", "d", "H", "h"])),
             "contains": sheet.where(C.contains_ci(F.col("Ciutat"), "NATION_1")),
             "repeated key": C.duplicated_rows(sheet, "DNI"),
             "answered and unknown": sheet.where(C.mask_and_null(F.col("Fills"), "True", F.col("Nombre_fills")))}
    out = None
    for q, rows in found.items():
        part = rows.select(F.lit(q).alias("question"), "_ord")
        out = part if out is None else out.unionByName(part)
    return out


@query("distinct_groups", "WITH " + S.SHEET + """ SELECT DISTINCT "Grup Professional" AS grup FROM sheet WHERE "Grup Professional" IS NOT NULL""")
def q_distinct(spark, d):
    return C.distinct_values(SV.survey_sheet(_t(spark, d)).select(F.col("Grup Professional").alias("grup")), "grup")


@query("nulls_first_order", "WITH " + S.SHEET + """
SELECT _ord, "Any de Naixement" AS any_naixement, row_number() OVER (ORDER BY "Any de Naixement" NULLS FIRST, _ord) AS place FROM sheet""")
def q_nulls_first(spark, d):
    """SRT1/SRT2/SRT7: ascending with NULLs first, the order proven by the place."""
    sheet = SV.survey_sheet(_t(spark, d)).select("_ord", F.col("Any de Naixement").alias("any_naixement"))
    return with_ordinal(sheet, [F.col("any_naixement").asc(), F.col("_ord").asc()], "place", start=1)


@query("unordered_limit", """SELECT least(count(*), 10) AS rows, least(count(*), 10) AS known FROM orders""")
def q_limit(spark, d):
    """SRT4: any ten rows; which ones is not defined, that they are rows of the table is."""
    orders = _t(spark, d).orders
    some = orders.select("o_orderkey").limit(10)
    return some.join(orders.select(F.col("o_orderkey").alias("_k")).distinct(), F.col("o_orderkey") == F.col("_k"), "left").agg(
        F.count("*").alias("rows"), F.count("_k").alias("known"))


@query("salary_wide", "WITH " + S.CLEAN + """
SELECT genere, round(avg(salari_mensual) FILTER (WHERE pais_origen = 'AFRICA'), 2) AS "AFRICA",
 round(avg(salari_mensual) FILTER (WHERE pais_origen = 'ASIA'), 2) AS "ASIA", round(avg(salari_mensual) FILTER (WHERE pais_origen = 'EUROPE'), 2) AS "EUROPE"
FROM clean GROUP BY genere""")
def q_wide(spark, d):
    """RSH2: means in a wide table, one column per named country."""
    return RS.pivot_mean(_clean(spark, d), "genere", "pais_origen", "salari_mensual", ["AFRICA", "ASIA", "EUROPE"])


# ------------------------------------------------------------------ DQ4, JN13-JN15, SET2, CLN8, AGG15, AGG21
@query("defaults_at_ingest", _V(t=M.TRANSACTIONS) + """
SELECT transaction_id, coalesce(business_id, -1) AS business_id, coalesce(CASE WHEN transaction_id % 7 = 0 THEN NULL ELSE declined END, false) AS declined FROM t""")
def q_defaults(spark, d):
    """DQ4: declared defaults where the input has no value."""
    t = src.transactions(_t(spark, d), False)
    holes = t.withColumn("declined", F.when(F.pmod("transaction_id", F.lit(7)) != 0, F.col("declined")))
    return Q.apply_defaults(holes, {"business_id": -1, "declined": False}).select("transaction_id", "business_id", "declined")


def _labels(spark):
    return spark.createDataFrame(list(E.GENDER_MAP.items()), "code string, label string")


@query("lookup_policies", "WITH " + S.SHEET + """, m(code, label) AS (VALUES """ + ", ".join(
    f"('{k}', '{v}')" for k, v in E.GENDER_MAP.items()) + """)
SELECT _ord, label AS mapped, coalesce(label, "Gènere") AS replaced, strict.name FROM sheet LEFT JOIN m ON "Gènere" = code
JOIN (SELECT n_name AS city, r_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey) strict ON "Ciutat" = city""")
def q_lookups(spark, d):
    """JN13-JN15: a miss is an error for cities (there is none), NULL or the value itself for codes."""
    t = _t(spark, d)
    sheet = SV.survey_sheet(t).select("_ord", F.col("Gènere").alias("code"), F.col("Ciutat").alias("city"))
    cities = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("city_name"), F.col("r_name").alias("name"))
    labels = _labels(spark)
    strict = RL.lookup(sheet, cities, "city", "city_name", "error")
    mapped = RL.lookup(strict, labels.select(F.col("code").alias("k"), F.col("label").alias("mapped")), "code", "k", "null")
    kept = RL.lookup(mapped.withColumn("replaced", F.col("code")), labels.select(F.col("code").alias("k"), "label"), "code", "k", "keep", keep_col="replaced")
    return kept.select("_ord", "mapped", "replaced", "name")


@query("lookup_misses", "WITH " + S.SHEET + """
SELECT DISTINCT "Grup Professional" AS grup FROM sheet WHERE "Grup Professional" IS NULL OR "Grup Professional" NOT IN ("""
       + ", ".join(f"'{k}'" for k in E.DEFAULT_POLICY["base_increment_by_group"]) + ")")
def q_misses(spark, d):
    """JN13: keys that a dictionary lookup would refuse."""
    sheet = SV.survey_sheet(_t(spark, d)).select(F.col("Grup Professional").alias("grup"))
    known = spark.createDataFrame([(k,) for k in E.DEFAULT_POLICY["base_increment_by_group"]], "k string")
    return RL.find_misses(sheet, known, "grup", "k").distinct()


@query("first_answers", "WITH " + S.SHEET + """
SELECT _ord, "DNI" AS dni FROM sheet QUALIFY row_number() OVER (PARTITION BY "DNI" ORDER BY _ord) = 1""")
def q_first(spark, d):
    """SET2: the first row of every key."""
    return RL.keep_first(SV.survey_sheet(_t(spark, d)).select("_ord", F.col("DNI").alias("dni")), ["dni"], "_ord")


@query("filled_by_group", """WITH e AS (SELECT event_id, event_type, CASE WHEN user_id % 3 = 0 OR event_type = 'error' THEN NULL ELSE value END AS v FROM events),
g AS (SELECT event_type AS t, median(v) AS m FROM e GROUP BY 1), f AS (SELECT event_id, event_type, coalesce(v, m) AS v FROM e LEFT JOIN g ON event_type = t)
SELECT event_id, event_type, round(coalesce(v, (SELECT median(v) FROM f)), 6) AS v FROM f""")
def q_filled(spark, d):
    """CLN8: missing values take their group's median, then the median of what that gave."""
    hole = (F.pmod("user_id", F.lit(3)) == 0) | (F.col("event_type") == "error")
    e = _t(spark, d).events.select("event_id", "event_type", F.when(~hole, F.col("value")).alias("v"))
    return RL.fill_from_group_then_global(e, "event_type", "v").withColumn("v", F.round("v", 6))


@query("salary_margins_wide", "WITH " + S.CLEAN + """, c AS (
SELECT CASE WHEN grouping(genere) = 1 THEN 'Mitjana_total' ELSE genere END AS genere,
  CASE WHEN grouping(pais_origen) = 1 THEN 'Mitjana_total' ELSE pais_origen END AS pais,
  CAST(round(CAST(avg(salari_mensual) AS DECIMAL(20,6)), 2) AS DOUBLE) AS mean
FROM clean WHERE genere IS NOT NULL AND pais_origen IS NOT NULL GROUP BY CUBE (genere, pais_origen))
SELECT genere, max(mean) FILTER (WHERE pais = 'ASIA') AS "ASIA", max(mean) FILTER (WHERE pais = 'EUROPE') AS "EUROPE",
  max(mean) FILTER (WHERE pais = 'Mitjana_total') AS "Mitjana_total" FROM c GROUP BY genere""")
def q_margins(spark, d):
    """AGG15: the wide form, a margin row and a margin column."""
    return RS.margins_wide(E.salary_gender_country(_clean(spark, d)), "genere", "pais_origen", ["ASIA", "EUROPE"])


@query("largest_transactions", _V(t=M.TRANSACTIONS) + """
(SELECT 'largest' AS which, transaction_id, CAST(amount AS DOUBLE) AS amount FROM t ORDER BY amount DESC, transaction_id LIMIT 1)
UNION ALL (SELECT 'smallest', transaction_id, CAST(amount AS DOUBLE) FROM t ORDER BY amount, transaction_id LIMIT 1)""")
def q_largest(spark, d):
    """AGG21: the rows of the greatest and the least amount, first on ties."""
    t = src.transactions(_t(spark, d), False).select("transaction_id", F.col("amount").cast("double").alias("amount"))
    return RL.arg_max(t, "amount", "transaction_id").select(F.lit("largest").alias("which"), "*").unionByName(
        RL.arg_max(t, "amount", "transaction_id", lowest=True).select(F.lit("smallest").alias("which"), "*"))
