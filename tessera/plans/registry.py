"""Registered queries over the driver tables, each with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Names are descriptive; the docstring of each plan function carries the
SURVEY operator IDs it covers.  Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import oracle_model as M
from tessera.plans import retail as R
from tessera.session import ensure_checkpoint_dir, scratch_dir
from tessera.sources import retail as src
from tessera.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Parameters for the driver tables.  Amounts are order totals (about 1,000
# times the reference's ticket sizes), so euro thresholds are scaled ×1000;
# counts are scaled to ~150 orders per supplier and ~10 per customer at sf0.01.
COUNTRY = "NATION_7"
PREMIUM_ABOVE = 260_000
BAND = (350_000, 400_000)
BAND_DAYS = ("1996-04-29", "1998-07-20", "2000-03-13")
RAW_BAND = (100_000, 200_000)
RAW_DAYS = ("29-04-1996", "20-07-1998", "13-03-2000")
CAPACITY = 150
FREQUENT = 15
COMPANY = "Supplier#000000001"
YEAR = "1998"
AS_OF = "2001-08-01 00:00:00"
RECENT_DAYS = 30
VIP_MIN = 500_000
MIDNIGHT_COUNTRY, MIDNIGHT_TS = "NATION_7", "1997-06-18 00:00:00"

_V = M.with_views


def _t(spark, d) -> Tables:
    ensure_checkpoint_dir(spark)  # reads spark.checkpoint.dir; sets one only when unset
    return Tables(spark, d)


def _silver(spark, d):
    return src.transactions_silver(src.transactions_raw(_t(spark, d)))


def _recent(spark, d):
    return R.redate(_silver(spark, d), AS_OF)


# ------------------------------------------------------------------ PIP8 (flagship)
@query("marketing_tiers", _V(companies=M.COMPANIES, transactions=M.TRANSACTIONS) + f"""
SELECT company_name, phone, country, {M.mean_money("amount")} AS mitja_compra,
 CASE WHEN sum(amount) / count(amount) > {PREMIUM_ABOVE} THEN 'Premium' ELSE 'Standard' END AS client_tier
FROM companies c JOIN transactions t ON c.company_id = t.business_id
WHERE NOT t.declined GROUP BY company_name, phone, country""")
def q_marketing_tiers(spark, d):
    t = _t(spark, d)
    return R.marketing_tiers(src.companies(t), src.transactions(t, False), PREMIUM_ABOVE)


# ------------------------------------------------------------------ PIP1
@query("countries_with_sales", _V(companies=M.COMPANIES, transactions=M.TRANSACTIONS) + """
SELECT country FROM companies c JOIN transactions t ON c.company_id = t.business_id
WHERE NOT t.declined""")
def q_countries(spark, d):
    t = _t(spark, d)
    return R.countries_with_sales(src.companies(t), src.transactions(t, False))


@query("count_sales_countries", _V(companies=M.COMPANIES, transactions=M.TRANSACTIONS) + """
SELECT count(DISTINCT country) AS n_countries
FROM companies c JOIN transactions t ON c.company_id = t.business_id WHERE NOT t.declined""")
def q_count_countries(spark, d):
    t = _t(spark, d)
    return R.count_sales_countries(src.companies(t), src.transactions(t, False))


@query("top_company_mean_sale", _V(companies=M.COMPANIES, transactions=M.TRANSACTIONS) + f"""
SELECT company_name, {M.mean_money("amount")} AS mitja_superior_vendes
FROM companies c JOIN transactions t ON c.company_id = t.business_id WHERE NOT t.declined
GROUP BY company_name ORDER BY mitja_superior_vendes DESC, company_name LIMIT 1""")
def q_top_company(spark, d):
    t = _t(spark, d)
    return R.top_company_by_mean_sale(src.companies(t), src.transactions(t, False))


# ------------------------------------------------------------------ PIP2
_TCOLS = "transaction_id, card_id, business_id, \"timestamp\", amount, declined, user_id"


@query("transactions_of_country", _V(companies=M.COMPANIES, transactions=M.TRANSACTIONS) + f"""
SELECT {_TCOLS} FROM transactions
WHERE business_id IN (SELECT company_id FROM companies WHERE country = '{COUNTRY}')""")
def q_tx_country(spark, d):
    t = _t(spark, d)
    return R.transactions_of_country(src.companies(t), src.transactions(t, False), COUNTRY)


@query("transactions_if_country_exists", _V(companies=M.COMPANIES, transactions=M.TRANSACTIONS) + f"""
SELECT {_TCOLS} FROM transactions
WHERE EXISTS (SELECT company_id FROM companies WHERE country = '{COUNTRY}') AND NOT declined""")
def q_tx_exists(spark, d):
    t = _t(spark, d)
    return R.transactions_if_country_exists(src.companies(t), src.transactions(t, False), COUNTRY)


@query("companies_above_mean", _V(companies=M.COMPANIES, transactions=M.TRANSACTIONS) + """
SELECT company_name FROM companies WHERE company_id IN (
  SELECT business_id FROM transactions WHERE amount > (SELECT avg(amount) FROM transactions))""")
def q_above_mean(spark, d):
    t = _t(spark, d)
    return R.companies_above_mean(src.companies(t), src.transactions(t, False))


@query("companies_without_transactions", _V(companies=M.COMPANIES, transactions=M.TRANSACTIONS) + """
SELECT * FROM companies c WHERE NOT EXISTS (SELECT 1 FROM transactions t WHERE c.company_id = t.business_id)""")
def q_no_tx(spark, d):
    t = _t(spark, d)
    return R.companies_without_transactions(src.companies(t), src.transactions(t, False))


@query("users_without_declines", _V(users=M.USERS, transactions=M.TRANSACTIONS) + """
SELECT * FROM users u WHERE NOT EXISTS (SELECT 1 FROM transactions t WHERE t.user_id = u.user_id AND t.declined)""")
def q_users_no_declines(spark, d):
    t = _t(spark, d)
    return R.users_without_transactions(src.users(t), src.transactions(t, False).filter("declined"))


# ------------------------------------------------------------------ PIP3 / PIP4
@query("frequent_users", _V(users=M.USERS, transactions=M.TRANSACTIONS) + f"""
SELECT * FROM users u WHERE EXISTS (
  SELECT count(transaction_id) FROM transactions t WHERE t.user_id = u.user_id
  GROUP BY user_id HAVING count(transaction_id) > {FREQUENT})""")
def q_frequent(spark, d):
    t = _t(spark, d)
    return R.frequent_users(src.users(t), src.transactions(t, False), FREQUENT)


@query("mean_spend_per_card", _V(cards=M.CARDS, companies=M.COMPANIES, transactions=M.TRANSACTIONS) + f"""
SELECT cc.iban, {M.mean_money("t.amount")} AS media_gasto
FROM cards cc JOIN transactions t ON cc.card_id = t.card_id
JOIN companies c ON t.business_id = c.company_id
WHERE c.company_name = '{COMPANY}' GROUP BY cc.iban""")
def q_card_spend(spark, d):
    t = _t(spark, d)
    return R.mean_spend_per_card_at_company(src.cards(t), src.transactions(t, False),
                                            src.companies(t), COMPANY)


# ------------------------------------------------------------------ PIP5 / PIP6 / PIP7
@query("best_sales_days", _V(transactions=M.TRANSACTIONS) + """
SELECT CAST("timestamp" AS DATE) AS fechas_ventas, CAST(sum(amount) AS DOUBLE) AS total_ventas
FROM transactions GROUP BY 1 ORDER BY total_ventas DESC, fechas_ventas LIMIT 5""")
def q_best_days(spark, d):
    return R.best_sales_days(src.transactions(_t(spark, d), False))


@query("daily_sales_of_year_raw", _V(raw=M.RAW) + f"""
SELECT substr("timestamp", 1, 10) AS date,
 CAST(round(sum(CAST(amount AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_amount
FROM raw WHERE substr("timestamp", 1, 4) = '{YEAR}' AND declined = '0'
GROUP BY 1 ORDER BY total_amount DESC, date LIMIT 5""")
def q_daily_raw(spark, d):
    return R.daily_sales_of_year_raw(src.transactions_raw(_t(spark, d)), YEAR)


@query("companies_in_band_on_days", _V(companies=M.COMPANIES, transactions=M.TRANSACTIONS) + f"""
SELECT company_name, phone, country, CAST("timestamp" AS DATE) AS fecha_transaccion, amount
FROM companies c JOIN transactions t ON c.company_id = t.business_id
WHERE amount BETWEEN {BAND[0]} AND {BAND[1]}
AND CAST("timestamp" AS DATE) IN ({", ".join(f"DATE '{x}'" for x in BAND_DAYS)})""")
def q_band_days(spark, d):
    t = _t(spark, d)
    return R.companies_in_band_on_days(src.companies(t), src.transactions(t, False),
                                       BAND[0], BAND[1], BAND_DAYS)


@query("companies_in_band_on_days_raw", _V(companies=M.COMPANIES, raw=M.RAW) + f"""
SELECT company_name, country,
 strftime(TRY_CAST(substr(t."timestamp", 1, 10) AS DATE), '%d-%m-%Y') AS fecha_inversa
FROM raw t JOIN companies c ON t.business_id = CAST(c.company_id AS VARCHAR)
WHERE t.declined = '0' AND CAST(t.amount AS DOUBLE) BETWEEN {RAW_BAND[0]} AND {RAW_BAND[1]}
AND strftime(TRY_CAST(substr(t."timestamp", 1, 10) AS DATE), '%d-%m-%Y')
    IN ({", ".join(f"'{x}'" for x in RAW_DAYS)})""")
def q_band_days_raw(spark, d):
    t = _t(spark, d)
    return R.companies_in_band_on_days_raw(src.companies(t), src.transactions_raw(t),
                                           RAW_BAND[0], RAW_BAND[1], RAW_DAYS)


@query("capacity_band", _V(companies=M.COMPANIES, transactions=M.TRANSACTIONS) + f"""
SELECT company_name, count(transaction_id) AS total_transacciones,
 CASE WHEN count(transaction_id) >= {CAPACITY} THEN '{CAPACITY} o més transaccions'
      ELSE 'Menys de {CAPACITY} transaccions' END AS capacidad_operativa
FROM companies c JOIN transactions t ON c.company_id = t.business_id GROUP BY company_name""")
def q_capacity(spark, d):
    t = _t(spark, d)
    return R.capacity_band(src.companies(t), src.transactions(t, False), CAPACITY)


# ------------------------------------------------------------------ PIP9 / PIP10
@query("active_cards", _V(transactions=M.TRANSACTIONS) + """
, ranked AS (SELECT card_id, declined, row_number() OVER (
    PARTITION BY card_id ORDER BY CAST(transaction_id AS VARCHAR) DESC) AS rn FROM transactions)
, per_card AS (SELECT card_id, CASE WHEN sum(CASE WHEN NOT declined THEN 1 ELSE 0 END) > 0
    THEN 'Activa' ELSE 'Inactiva' END AS estat FROM ranked WHERE rn <= 3 GROUP BY card_id)
SELECT count(*) AS total_tarjetas_activas FROM per_card WHERE estat = 'Activa'""")
def q_active_cards(spark, d):
    return R.active_cards(src.transactions(_t(spark, d), False))


@query("product_sales_membership", _V(transactions=M.TRANSACTIONS, products=M.PRODUCTS) + """
SELECT p.product_id AS id, p.name AS product_name, count(*) AS veces_vendido
FROM transactions t JOIN products p
  ON list_contains(list_distinct(string_split(replace(t.product_ids, ' ', ''), ',')),
                   CAST(p.product_id AS VARCHAR))
GROUP BY p.product_id, p.name""")
def q_membership(spark, d):
    t = _t(spark, d)
    return R.product_sales_membership_lines(src.transaction_lines(t), src.products(t))


@query("product_sales_ranking", _V(p=M.SILVER_PRODUCTS, t=M.SILVER_TRANSACTIONS) + """
SELECT p.product_id, p.name, p.price, p.colour, count(f.id_aplanado) AS total_sold
FROM p LEFT JOIN (SELECT TRY_CAST(x AS BIGINT) AS id_aplanado
                  FROM t, unnest(string_split(t.product_ids, ', ')) AS u(x)) f
  ON p.product_id = f.id_aplanado
GROUP BY p.product_id, p.name, p.price, p.colour""")
def q_ranking(spark, d):
    t = _t(spark, d)
    return R.product_sales_ranking_lines(src.products_silver(src.products(t)), src.transaction_lines(t))


# The same questions on rows that hold a list: one basket per order line, whose
# list is made of that row's own keys (no list is collected from several rows).
_BASKET_SQL = """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
 CAST(l_partkey AS VARCHAR) || ', ' || CAST(l_suppkey AS VARCHAR) || ', ' || CAST(l_partkey AS VARCHAR)
   || CASE WHEN l_linenumber % 3 = 0 THEN ', x' ELSE '' END AS product_ids,
 l_extendedprice AS amount, CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS declined,
 l_shipdate AS "timestamp" FROM lineitem"""


def _baskets(spark, d) -> DataFrame:
    k = F.col("l_partkey").cast("string")
    return _t(spark, d).lineitem.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.concat(F.concat_ws(", ", k, F.col("l_suppkey").cast("string"), k),
                 F.when(F.col("l_linenumber") % 3 == 0, F.lit(", x")).otherwise(F.lit(""))).alias("product_ids"),
        F.col("l_extendedprice").alias("amount"),
        F.when(F.col("l_returnflag") == "R", F.lit("1")).otherwise(F.lit("0")).alias("declined"),
        F.col("l_shipdate").alias("timestamp"))


@query("basket_membership", _V(t=_BASKET_SQL, p=M.PRODUCTS) + """
SELECT p.product_id AS id, p.name AS product_name, count(*) AS veces_vendido
FROM (SELECT unnest(list_distinct(string_split(replace(product_ids, ' ', ''), ','))) AS m FROM t) x
JOIN p ON x.m = CAST(p.product_id AS VARCHAR) GROUP BY p.product_id, p.name""")
def q_basket_membership(spark, d):
    return R.product_sales_membership(_baskets(spark, d), src.products(_t(spark, d)))


@query("basket_ranking", _V(t=_BASKET_SQL, p=M.SILVER_PRODUCTS) + """
SELECT p.product_id, p.name, p.price, p.colour, count(f.k) AS total_sold
FROM p LEFT JOIN (SELECT TRY_CAST(unnest(string_split(product_ids, ', ')) AS BIGINT) AS k FROM t) f ON p.product_id = f.k
GROUP BY p.product_id, p.name, p.price, p.colour""")
def q_basket_ranking(spark, d):
    return R.product_sales_ranking(src.products_silver(src.products(_t(spark, d))), _baskets(spark, d))


_BASKET_FLAT = _V(t=_BASKET_SQL, p=M.SILVER_PRODUCTS) + """
, x AS (SELECT transaction_id, "timestamp", amount AS total_ticket,
   TRY_CAST(unnest(string_split(product_ids, ', ')) AS BIGINT) AS product_sku FROM t WHERE declined = '0')
, f AS (SELECT x.*, p.name AS product_name, p.price AS product_price, p.price * 1.21 AS producto_price_tax_inc,
   p.category FROM x JOIN p ON x.product_sku = p.product_id)
"""


@query("basket_flat_sales", _BASKET_FLAT + "SELECT * FROM f")
def q_basket_flat(spark, d):
    return R.flat_sales(_baskets(spark, d), src.products_silver(src.products(_t(spark, d))))


@query("basket_top_products", _BASKET_FLAT + """
SELECT product_name, count(product_sku) AS total_vendido FROM f GROUP BY product_name
ORDER BY total_vendido DESC, product_name LIMIT 5""")
def q_basket_top(spark, d):
    return R.top_products(q_basket_flat(spark, d))


# ------------------------------------------------------------------ PIP11 silver
@query("silver_companies", _V(c=M.COMPANIES) + "SELECT * FROM c")
def q_silver_companies(spark, d):
    return src.companies(_t(spark, d))


@query("silver_cards", """SELECT c_custkey AS card_id, c_custkey AS user_id,
 'XX' || lpad(CAST(c_custkey AS VARCHAR), 20, '0') AS iban,
 make_date(CASE WHEN (c_custkey * 7) % 100 < 70 THEN 2000 ELSE 1900 END + CAST((c_custkey * 7) % 100 AS INTEGER),
   CAST(c_custkey % 12 + 1 AS INTEGER), CAST(c_custkey % 28 + 1 AS INTEGER)) AS expiring_date FROM customer""")
def q_silver_cards(spark, d):
    return src.cards(_t(spark, d))


@query("silver_transactions", _V(t=M.SILVER_TRANSACTIONS) + """
SELECT transaction_id, card_id, business_id, "timestamp", amount, declined,
 len(string_split(product_ids, ', ')) AS n_products,
 array_to_string(list_transform(string_split(product_ids, ', '), lambda x: TRY_CAST(x AS BIGINT)), ',') AS product_list,
 user_id FROM t""")
def q_silver_tx(spark, d):
    s = _silver(spark, d)
    return s.select("transaction_id", "card_id", "business_id", "timestamp", "amount", "declined",
                    F.array_size("product_ids").alias("n_products"),
                    F.array_join(F.col("product_ids").cast("array<string>"), ",").alias("product_list"),
                    "user_id")


@query("silver_users", _V(u=M.USERS) + "SELECT * FROM u")
def q_silver_users(spark, d):
    return src.users(_t(spark, d))


@query("silver_products", M.SILVER_PRODUCTS)
def q_silver_products(spark, d):
    return src.products_silver(src.products(_t(spark, d)))


# ------------------------------------------------------------------ PIP13-PIP15
_RECENT = M.recent(AS_OF)


@query("redated_transactions", _V(r=_RECENT) + """
SELECT transaction_id, business_id, amount, declined, "timestamp" FROM r""")
def q_redated(spark, d):
    return _recent(spark, d).select("transaction_id", "business_id", "amount", "declined", "timestamp")


def _fact(spark, d) -> DataFrame:
    """PIP14: write the partitioned/clustered fact once per call, read it back."""
    path = scratch_dir(spark, "fact_transactions")
    R.write_partitioned_fact(_recent(spark, d).drop("product_ids"), path)
    return spark.read.parquet(path)


@query("recent_30_days", _V(r=_RECENT) + f"""
SELECT transaction_id, business_id, amount, declined, CAST("timestamp" AS DATE) AS date FROM r
WHERE CAST("timestamp" AS DATE) >= DATE '{AS_OF[:10]}' - INTERVAL {RECENT_DAYS} DAY""")
def q_recent(spark, d):
    return R.recent_days(_fact(spark, d), AS_OF[:10], RECENT_DAYS).select(
        "transaction_id", "business_id", "amount", "declined", "date")


_MV = _V(r=_RECENT) + """, mv AS (SELECT sum(CAST(amount AS DECIMAL(18,2))) AS total_vendes, CAST("timestamp" AS DATE) AS fecha
FROM r GROUP BY fecha)
"""


def _mv(spark, d) -> DataFrame:
    return R.daily_sales(_recent(spark, d).withColumn("date", F.to_date("timestamp")))


@query("daily_sales_report", _MV + "SELECT CAST(round(total_vendes, 2) AS DOUBLE) AS total_vendes, fecha FROM mv")
def q_daily_report(spark, d):
    return R.daily_sales_report(_mv(spark, d))


# ------------------------------------------------------------------ PIP16-PIP19
@query("vip_customers", _V(r=_RECENT, u=M.USERS) + f"""
SELECT u.user_id, u.name || ' ' || u.surname AS nom_complet, u.email,
 CAST(round(sum(CAST(t.amount AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_gastat,
 count(t.transaction_id) AS num_compres,
 {M.mean_money("t.amount")} AS tiquet_mitja,
 max(t.amount) AS compra_maxima
FROM r t JOIN u ON t.user_id = CAST(u.user_id AS VARCHAR) WHERE t.declined = '0'
GROUP BY u.user_id, u.name, u.surname, u.email
HAVING round(sum(CAST(t.amount AS DECIMAL(18,2))), 2) > {VIP_MIN}""")
def q_vip(spark, d):
    return R.vip_customers(_recent(spark, d), src.users(_t(spark, d)), VIP_MIN)


@query("day_over_day", _MV + """
, h AS (SELECT fecha, total_vendes, lag(total_vendes) OVER (ORDER BY fecha) AS prev FROM mv)
SELECT fecha AS "Data", CAST(round(total_vendes, 2) AS DOUBLE) AS "Vendes_Avui",
 CAST(round(prev, 2) AS DOUBLE) AS "Vendes_Ahir",
 round((total_vendes - prev) / nullif(prev, 0) * 100, 2) AS "Diff_Percentual" FROM h""")
def q_dod(spark, d):
    return R.day_over_day(_mv(spark, d))


@query("year_to_date", _MV + """
, h AS (SELECT fecha AS "Data", round(total_vendes, 2) AS v FROM mv)
SELECT "Data", CAST(v AS DOUBLE) AS "Vendes_del_Dia", CAST(round(sum(v) OVER (PARTITION BY year("Data")
  ORDER BY "Data" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS DOUBLE) AS "Vendes_Acumulades_YTD"
FROM h""")
def q_ytd(spark, d):
    return R.year_to_date(_mv(spark, d))


_LAST = 'OVER (ORDER BY "timestamp", transaction_id)'


@query("transaction_changes", _V(t=M.TRANSACTIONS) + f"""
SELECT transaction_id, "timestamp", CAST(amount AS DOUBLE) AS amount, CAST(lag(amount) {_LAST} AS DOUBLE) AS previous_amount,
 round((CAST(amount AS DOUBLE) - CAST(lag(amount) {_LAST} AS DOUBLE)) / nullif(CAST(lag(amount) {_LAST} AS DOUBLE), 0) * 100, 2) AS diff_percent,
 CAST(sum(amount) {_LAST[:-1]} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
 CAST(sum(amount) OVER (PARTITION BY year("timestamp") ORDER BY "timestamp", transaction_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS year_total
FROM t""")
def q_changes(spark, d):
    return R.transaction_changes(src.transactions(_t(spark, d), False))


@query("third_purchase", _V(r=_RECENT, u=M.USERS) + f"""
, c AS (SELECT u.user_id, u.name || ' ' || u.surname AS nom_complet, u.email, t.amount AS import_3a_compra,
   {M.mean_money("t.amount", ' OVER (PARTITION BY u.user_id ORDER BY t."timestamp")')} AS compra_media,
   t."timestamp" AS data_3a_compra,
   row_number() OVER (PARTITION BY u.user_id ORDER BY t."timestamp", t.transaction_id) AS num_compra
  FROM u JOIN r t ON t.user_id = CAST(u.user_id AS VARCHAR) WHERE t.declined = '0')
SELECT user_id, nom_complet, email, compra_media, import_3a_compra,
 data_3a_compra FROM c WHERE num_compra = 3""")
def q_third(spark, d):
    return R.third_purchase(src.users(_t(spark, d)), _recent(spark, d))


# ------------------------------------------------------------------ PIP20 / PIP21 / FLT7
_FLAT = _V(r=_RECENT, p=M.SILVER_PRODUCTS) + """
, flat AS (SELECT r.transaction_id, r."timestamp", r.amount AS total_ticket,
   TRY_CAST(x AS BIGINT) AS product_sku FROM r, unnest(string_split(r.product_ids, ', ')) AS u(x)
   WHERE r.declined = '0')
, f AS (SELECT flat.*, p.name AS product_name, p.price AS product_price,
   p.price * 1.21 AS producto_price_tax_inc, p.category
   FROM flat JOIN p ON flat.product_sku = p.product_id)
"""


def _flat(spark, d):
    t = _t(spark, d)
    recent = R.redate(src.transactions_silver(src.transactions_raw_without_products(t)), AS_OF)
    return R.flat_sales_lines(recent, src.line_products(t), src.products_silver(src.products(t)))


@query("flat_sales", _FLAT + "SELECT * FROM f")
def q_flat(spark, d):
    return _flat(spark, d)


@query("top_products", _FLAT + """
SELECT product_name, count(product_sku) AS total_vendido FROM f GROUP BY product_name
ORDER BY total_vendido DESC, product_name LIMIT 5""")
def q_top_products(spark, d):
    return R.top_products(_flat(spark, d))


@query("company_transactions_at_midnight", _V(c=M.COMPANIES, t=M.SILVER_TRANSACTIONS) + f"""
SELECT c.company_name, t.transaction_id, t.card_id, t.business_id, t."timestamp", t.amount, t.declined,
 t.user_id FROM c JOIN t ON CAST(c.company_id AS VARCHAR) = t.business_id
WHERE c.country = '{MIDNIGHT_COUNTRY}' AND t."timestamp" = TIMESTAMP '{MIDNIGHT_TS}'""")
def q_midnight(spark, d):
    t = _t(spark, d)
    return R.company_transactions_at(src.companies(t), _silver(spark, d).drop("product_ids"),
                                     MIDNIGHT_COUNTRY, MIDNIGHT_TS)


# ================================================================== scoring (PIP22-PIP25)
from tessera.plans import oracle_survey as S  # noqa: E402
from tessera.plans import scoring as SC  # noqa: E402
from tessera.sources import scoring_inputs as SI  # noqa: E402

_CAND = """cand AS (SELECT c_custkey AS ord,
  CASE WHEN c_custkey % 5 = 0 THEN '  ' || c_name ELSE c_name END AS nombre_completo,
  '6' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS telefono,
  CAST(c_custkey % 10 AS INTEGER) AS "años_experiencia", CAST(c_nationkey % 5 AS INTEGER) AS catalan,
  CAST(c_custkey % 4 AS INTEGER) AS excel, CAST((c_custkey * 3) % 4 AS INTEGER) AS estudios FROM customer),
cn AS (SELECT ord, """ + S.norm("nombre_completo") + """ AS nombre_completo, telefono, "años_experiencia",
  catalan, excel, estudios FROM cand)
"""


@query("candidate_scores", "WITH " + _CAND + """
SELECT *, CAST("años_experiencia" * 1.5 + catalan + excel + estudios AS DOUBLE) AS puntuacion_total,
  CASE WHEN "años_experiencia" * 1.5 + catalan + excel + estudios >= 12 THEN 'prioridad alta'
       WHEN "años_experiencia" * 1.5 + catalan + excel + estudios >= 8 THEN 'candidato_adecuado'
       ELSE 'no prioritario' END AS clasificacion
FROM cn WHERE catalan BETWEEN 0 AND 3 AND excel BETWEEN 0 AND 3 AND estudios BETWEEN 0 AND 3""")
def q_candidates(spark, d):
    return SC.score_candidates(SI.candidates(_t(spark, d)))[0]


@query("candidate_rejects", "WITH " + _CAND + """
SELECT * FROM cn WHERE NOT (catalan BETWEEN 0 AND 3 AND excel BETWEEN 0 AND 3 AND estudios BETWEEN 0 AND 3)""")
def q_candidate_rejects(spark, d):
    return SC.score_candidates(SI.candidates(_t(spark, d)))[1]


@query("candidate_report", "WITH " + _CAND + """
SELECT *, row_number() OVER (ORDER BY puntuacion_total DESC, ord) AS rank FROM (
SELECT *, CAST("años_experiencia" * 1.5 + catalan + excel + estudios AS DOUBLE) AS puntuacion_total,
  CASE WHEN "años_experiencia" * 1.5 + catalan + excel + estudios >= 12 THEN 'prioridad alta'
       WHEN "años_experiencia" * 1.5 + catalan + excel + estudios >= 8 THEN 'candidato_adecuado'
       ELSE 'no prioritario' END AS clasificacion
FROM cn WHERE catalan BETWEEN 0 AND 3 AND excel BETWEEN 0 AND 3 AND estudios BETWEEN 0 AND 3)""")
def q_candidate_report(spark, d):
    return SC.candidate_report(SC.score_candidates(SI.candidates(_t(spark, d)))[0])


@query("candidate_by_name", "WITH " + _CAND + """
SELECT *, CAST("años_experiencia" * 1.5 + catalan + excel + estudios AS DOUBLE) AS puntuacion_total,
  CASE WHEN "años_experiencia" * 1.5 + catalan + excel + estudios >= 12 THEN 'prioridad alta'
       WHEN "años_experiencia" * 1.5 + catalan + excel + estudios >= 8 THEN 'candidato_adecuado'
       ELSE 'no prioritario' END AS clasificacion
FROM cn WHERE catalan BETWEEN 0 AND 3 AND excel BETWEEN 0 AND 3 AND estudios BETWEEN 0 AND 3
  AND nombre_completo = 'customer#000000010'""")
def q_candidate_by_name(spark, d):
    return SC.find_candidate(SC.score_candidates(SI.candidates(_t(spark, d)))[0], " Customer#000000010 ")


#: Every product of the two factors, rounded by Python.
_RISKS = "CASE " + " ".join(
    f"WHEN codi_comportament = {code} AND grup_edat = '{ages}' THEN {round(a * b, 2)!r}::DOUBLE"
    for code, a in enumerate((0.10, 0.25, 0.50, 0.75, 0.90))
    for ages, b in (("18-25", 1.20), ("26-40", 1.0), ("41-60", 0.85), ("60+", 0.70))) + " END"


_CART = """WITH last AS (SELECT user_id, event_type FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
cl AS (SELECT user_id AS id_client, 'user_' || CAST(user_id AS VARCHAR) AS nom,
  CAST(18 + (user_id * 7) % 60 AS INTEGER) AS edat,
  CASE user_id % 4 WHEN 0 THEN '18-25' WHEN 1 THEN '26-40' WHEN 2 THEN '41-60' ELSE '60+' END AS grup_edat,
  CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3
    WHEN 'error' THEN 4 END AS codi_comportament FROM last),
risk AS (SELECT *,
  CASE codi_comportament WHEN 0 THEN 'Navega pero no añade productos'
    WHEN 1 THEN 'Añade productos pero no llega al checkout' WHEN 2 THEN 'Llega al checkout pero no hace el pago'
    WHEN 3 THEN 'Cesta de la compra abandonada hace menos de 24h'
    WHEN 4 THEN 'Cesta de la compra abandonada hace más de 24h' END AS segment,
  CASE codi_comportament WHEN 0 THEN 0.10::DOUBLE WHEN 1 THEN 0.25::DOUBLE WHEN 2 THEN 0.50::DOUBLE
    WHEN 3 THEN 0.75::DOUBLE WHEN 4 THEN 0.90::DOUBLE END AS factor_codi,
  CASE grup_edat WHEN '18-25' THEN 1.20::DOUBLE WHEN '26-40' THEN 1.0::DOUBLE WHEN '41-60' THEN 0.85::DOUBLE
    WHEN '60+' THEN 0.70::DOUBLE END AS factor_edad FROM cl),
rk AS (SELECT *, """ + _RISKS + """ AS risc_final FROM risk)
"""


@query("cart_risk", _CART + "SELECT * FROM rk")
def q_cart(spark, d):
    return SC.cart_risk(SI.cart_clients(_t(spark, d)))


@query("cart_risk_extremes", _CART + """
(SELECT 'highest_risk' AS question, id_client, risc_final FROM rk ORDER BY risc_final DESC, id_client LIMIT 1)
UNION ALL (SELECT 'lowest_risk', id_client, risc_final FROM rk ORDER BY risc_final, id_client LIMIT 1)
UNION ALL (SELECT 'most_profitable', id_client, risc_final FROM rk WHERE codi_comportament >= 3
           ORDER BY risc_final DESC, id_client LIMIT 1)""")
def q_cart_extremes(spark, d):
    return SC.cart_extremes(SC.cart_risk(SI.cart_clients(_t(spark, d))))


@query("cart_not_worth_investing", _CART + "SELECT * FROM rk WHERE codi_comportament <= 1")
def q_cart_not_worth(spark, d):
    return SC.not_worth_investing(SC.cart_risk(SI.cart_clients(_t(spark, d))))


@query("cart_codes_with_several", _CART + """
SELECT rk.*, g.group_size FROM rk JOIN (SELECT codi_comportament AS c, count(*) AS group_size FROM rk
  GROUP BY 1 HAVING count(*) >= 2) g ON rk.codi_comportament = g.c""")
def q_cart_several(spark, d):
    from tessera.operators.relational import groups_with_several
    return groups_with_several(SC.cart_risk(SI.cart_clients(_t(spark, d))), "codi_comportament")


_SYM = {"view": "tos", "click": " Fatiga", "signup": "dolor cabeza ", "error": "Fiebre Alta",
        "purchase": "dificultad RESPIRAR"}
_W = {"fiebre_alta": 3, "dificultad_respirar": 5, "dolor_pecho": 4, "tos": 1, "fatiga": 1, "dolor_cabeza": 1}


_TRIAGE = """WITH rec AS (SELECT event_id AS ord, 'user_' || CAST(user_id AS VARCHAR) || '|'
  || CAST(18 + (user_id * 7) % 60 AS VARCHAR) || '|'
  || CASE event_type """ + " ".join(f"WHEN {S.sq(k)} THEN {S.sq(v)}" for k, v in _SYM.items()) + """ END
  || CASE WHEN value > 15 THEN ', dolor_pecho' ELSE '' END AS record FROM events),
p AS (SELECT ord, record, string_split(record, '|') AS parts FROM rec),
q AS (SELECT ord, record, parts[1] AS nom, parts[2] AS edad,
  list_transform(string_split(parts[3], ','), lambda s: """ + S.norm("s") + """) AS sintomas FROM p)
SELECT ord, record, nom, edad, array_to_string(sintomas, ',') AS sintomas,
  CAST(list_sum(list_transform(sintomas, lambda s: CASE s """ + " ".join(
    f"WHEN {S.sq(k)} THEN {v}" for k, v in _W.items()) + """ END)) AS BIGINT) AS riesgo_total FROM q"""


@query("symptom_triage", _TRIAGE)
def q_triage(spark, d):
    out = SC.triage(SI.triage_records(_t(spark, d)))
    return out.withColumn("sintomas", F.array_join("sintomas", ","))


@query("triage_report", "SELECT *, row_number() OVER (ORDER BY riesgo_total DESC, ord) AS rank FROM (" + _TRIAGE + ")")
def q_triage_report(spark, d):
    out = SC.triage_report(SI.triage_records(_t(spark, d)))
    return out.withColumn("sintomas", F.array_join("sintomas", ","))


_INS = """WITH cl AS (SELECT c_custkey AS ord, c_name AS nombre, CAST(18 + (c_custkey * 7) % 60 AS INTEGER) AS edad,
  CAST(c_custkey % 4 AS INTEGER) AS codigo FROM customer),
pr AS (SELECT *, CASE codigo WHEN 0 THEN 'Baix risc' WHEN 1 THEN 'Risc mitjà' WHEN 2 THEN 'Risc alt'
    WHEN 3 THEN 'Risc crític' END AS categoria,
  CASE codigo WHEN 0 THEN 120 WHEN 1 THEN 200 WHEN 2 THEN 350 WHEN 3 THEN 500 END AS precio_base,
  CASE codigo WHEN 0 THEN 0.01::DOUBLE WHEN 1 THEN 0.05::DOUBLE WHEN 2 THEN 0.15::DOUBLE
    WHEN 3 THEN 0.30::DOUBLE END AS probabilidad_fraude FROM cl),
fin AS (SELECT *, precio_base * (1 + edad / 100) AS precio_final FROM pr)
"""


@query("insurance_prices", _INS + "SELECT * FROM fin")
def q_insurance(spark, d):
    return SC.insurance_prices(SI.insurance_clients(_t(spark, d)))


@query("insurance_by_fraud", _INS + "SELECT *, row_number() OVER (ORDER BY probabilidad_fraude DESC, ord) AS rank FROM fin")
def q_insurance_by_fraud(spark, d):
    return SC.insurance_ranking(SC.insurance_prices(SI.insurance_clients(_t(spark, d))), "probabilidad_fraude")


@query("insurance_by_price", _INS + "SELECT *, row_number() OVER (ORDER BY precio_final DESC, ord) AS rank FROM fin")
def q_insurance_by_price(spark, d):
    return SC.insurance_ranking(SC.insurance_prices(SI.insurance_clients(_t(spark, d))), "precio_final")


@query("insurance_answers", _INS + """
(SELECT 'most_fraud' AS question, nombre, ord FROM fin ORDER BY probabilidad_fraude DESC, ord LIMIT 1)
UNION ALL (SELECT 'highest_price', nombre, ord FROM fin ORDER BY precio_final DESC, ord LIMIT 1)
UNION ALL (SELECT 'review_first', nombre, ord FROM fin ORDER BY probabilidad_fraude DESC, ord LIMIT 1)""")
def q_insurance_answers(spark, d):
    return SC.insurance_answers(SC.insurance_prices(SI.insurance_clients(_t(spark, d))))


# ================================================================== employees (PIP26-PIP31)
from tessera.operators import quality as Q  # noqa: E402
from tessera.operators.key_bitmaps import key_report, orphan_rows  # noqa: E402
from tessera.plans import employees as E  # noqa: E402
from tessera.sources import survey as SV  # noqa: E402

_CLEAN_COLS = ("_ord, nom, cognoms, dni, pais_origen, ciutat, genere, salari_mensual, grup_professional, "
               "nombre_fills, te_cotxe, km_anuals, consum_mitja_l_100km, temperatura_mitjana_ciutat, data_naixement")


_CLEANED: dict[tuple, str] = {}  # (application, input files) -> the silver table of this session


def _input_files(spark, d) -> tuple:
    """A digest of name, size and time of every file that the sheet is made of: a changed input is another input."""
    files = spark.read.format("binaryFile").load([f"{d}/{t}.parquet" for t in ("customer", "nation", "region")])
    one = files.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("digest"))
    return tuple(one.first())  # the contents are not read


def _clean(spark, d):
    """The silver employee table: cleaned and written once per session and input, read by every report."""
    key = (spark.sparkContext.applicationId, d, _input_files(spark, d))
    if key in _CLEANED:
        try:
            return spark.read.parquet(_CLEANED[key])
        except AnalysisException:  # the scratch folder was emptied meanwhile: clean again
            pass
    path = scratch_dir(spark, "employees_silver")
    E.clean_employees(SV.survey_sheet(_t(spark, d)))[0].write.parquet(path)
    _CLEANED[key] = path
    return spark.read.parquet(path)


def _priced(spark, d):
    return E.apply_salary_policy(E.enrich_with_city(_clean(spark, d), SV.city_context(_t(spark, d))))


_PRICED = "WITH " + S.priced(E.DEFAULT_POLICY) + "\n"


@query("employees_clean", "WITH " + S.CLEAN + f"\nSELECT {_CLEAN_COLS} FROM clean")
def q_emp_clean(spark, d):
    """The cleaning itself, timed on its own; the reports below read the written table."""
    return E.clean_employees(SV.survey_sheet(_t(spark, d)))[0].select(*[c.strip() for c in _CLEAN_COLS.split(",")])


@query("employees_dropped", "WITH " + S.SHEET + """,
keys_ AS (SELECT "DNI" AS k, count(DISTINCT ("Nom", "Cognoms", "Ciutat", "Gènere")) AS ids
          FROM sheet WHERE "DNI" IS NOT NULL GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "DNI" ORDER BY _ord) AS rn FROM sheet)
SELECT _ord, "DNI", CASE WHEN "DNI" IN (SELECT k FROM keys_ WHERE ids > 1) THEN 'conflicting_identity'
  ELSE 'resubmitted_duplicate' END AS reason
FROM ranked WHERE "DNI" IN (SELECT k FROM keys_ WHERE ids > 1) OR rn > 1""")
def q_emp_dropped(spark, d):
    return Q.resolve_key_conflicts(SV.survey_sheet(_t(spark, d)), "DNI", E.IDENTITY_COLS, "_ord")[1].select(
        "_ord", "DNI", "reason")


@query("salary_by_gender", "WITH " + S.CLEAN + """
SELECT genere, CAST(round(CAST(avg(salari_mensual) AS DECIMAL(20,6)), 2) AS DOUBLE) AS sou_mig, CAST(round(CAST(median(salari_mensual) AS DECIMAL(20,6)), 2) AS DOUBLE) AS mediana,
  CAST(round(CAST(min(salari_mensual) AS DECIMAL(20,6)), 2) AS DOUBLE) AS minim, CAST(round(CAST(max(salari_mensual) AS DECIMAL(20,6)), 2) AS DOUBLE) AS maxim
FROM clean WHERE genere IS NOT NULL GROUP BY genere""")
def q_salary_gender(spark, d):
    return E.salary_by_gender(_clean(spark, d))


@query("salary_gender_country", "WITH " + S.CLEAN + """
SELECT CASE WHEN grouping(genere) = 1 THEN 'Mitjana_total' ELSE genere END AS genere,
  CASE WHEN grouping(pais_origen) = 1 THEN 'Mitjana_total' ELSE pais_origen END AS pais_origen,
  CAST(round(CAST(avg(salari_mensual) AS DECIMAL(20,6)), 2) AS DOUBLE) AS mean
FROM clean WHERE genere IS NOT NULL AND pais_origen IS NOT NULL GROUP BY CUBE (genere, pais_origen)""")
def q_salary_gc(spark, d):
    return E.salary_gender_country(_clean(spark, d))


_PRICED_COLS = ("dni, grup_professional, salari_mensual, \"Cost_vida_index\", \"Transport_public_score\", "
                "incremento_base, incremento_hijo, edad, incremento_edad, coste_de_vida, inc_cost_vida, "
                "incremento_transporte, incremento_total, inc_total_porcentaje, nou_salari")


@query("salary_policy", _PRICED + f"SELECT {_PRICED_COLS} FROM priced")
def q_policy(spark, d):
    return _priced(spark, d).select(*[c.strip().strip('"') for c in _PRICED_COLS.split(",")])


@query("policy_gaps", _PRICED + """
, reasons AS (SELECT 'no_group_increment' AS reason FROM priced WHERE incremento_base IS NULL
  UNION ALL SELECT 'no_city_context' FROM priced WHERE "Cost_vida_index" IS NULL
  UNION ALL SELECT 'no_birth_date' FROM priced WHERE edad IS NULL)
SELECT reason, count(*) AS "rows" FROM reasons GROUP BY reason""")
def q_policy_gaps(spark, d):
    return E.policy_gaps(_priced(spark, d))


@query("employee_features", _PRICED + """
SELECT dni, salari_mensual / (nombre_fills + 1) AS index_dependencia_familiar,
  salari_mensual / "Cost_vida_index" AS index_coste_vida, nombre_fills * edad AS responsabilidad_familiar,
  km_anuals / nullif(temperatura_mitjana_ciutat, 0.0) AS index_mobilitat,
  CASE WHEN nombre_fills = 0 THEN 0 WHEN nombre_fills <= 2 THEN 1 ELSE 2 END AS etapa_vital FROM priced""")
def q_features(spark, d):
    return E.features(_priced(spark, d)).select(
        "dni", "index_dependencia_familiar", "index_coste_vida", "responsabilidad_familiar",
        "index_mobilitat", "etapa_vital")


@query("employees_long", _PRICED + """
, m AS (SELECT dni, salari_mensual, nou_salari, inc_total_porcentaje, consum_mitja_l_100km,
  temperatura_mitjana_ciutat, "Transport_public_score", "Cost_vida_index" FROM priced)
SELECT dni, metrica, valor FROM m UNPIVOT INCLUDE NULLS (valor FOR metrica IN (salari_mensual, nou_salari,
  inc_total_porcentaje, consum_mitja_l_100km, temperatura_mitjana_ciutat, "Transport_public_score",
  "Cost_vida_index"))""")
def q_long(spark, d):
    return E.to_long(_priced(spark, d)).select("dni", "metrica", "valor")


@query("group_summary", _PRICED + """
SELECT grup_professional, count(dni) AS nombre_trabajador, CAST(round(CAST(avg(salari_mensual) AS DECIMAL(20,6)), 2) AS DOUBLE) AS salari_mig,
  avg(edad) AS edad_media, median(edad) AS edad_mediana
FROM priced WHERE grup_professional IS NOT NULL GROUP BY grup_professional""")
def q_group_summary(spark, d):
    return E.group_summary(_priced(spark, d))


_EXPORTED = """
, labels AS (SELECT label, replace(label, ' ', '') AS base, row_number() OVER (PARTITION BY replace(label, ' ', '') ORDER BY label) AS n
  FROM (SELECT DISTINCT label FROM spaced))
SELECT 'dades_' || base || CASE WHEN n > 1 THEN '_' || n ELSE '' END AS file, s.label AS grup_professional, dni, nom, salari_mensual, nou_salari
FROM spaced s JOIN labels l ON s.label = l.label"""


def _spaced(df):
    """Every third label is written with a blank, so that labels differ by blanks only."""
    label = F.col("grup_professional")
    odd = F.pmod(F.substring("dni", 1, 8).cast("bigint"), F.lit(3)) == 0
    return df.withColumn("grup_professional", F.when(odd, F.concat(F.substring(label, 1, 2), F.lit(" "), F.substring(label, 3, 99))).otherwise(label))


@query("group_export", _PRICED + """
, spaced AS (SELECT *, CASE WHEN CAST(substr(dni, 1, 8) AS BIGINT) % 3 = 0 THEN substr(grup_professional, 1, 2) || ' ' || substr(grup_professional, 3)
  ELSE grup_professional END AS label FROM priced WHERE grup_professional IS NOT NULL)""" + _EXPORTED)
def q_group_export(spark, d):
    """Every exported row as its file holds it, with the folder's name."""
    from tessera.sinks.writers import export_per_group
    path = scratch_dir(spark, "group_export")
    export_per_group(E.features(_spaced(_priced(spark, d))).drop("data_naixement"), "grup_professional", path)
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col("_file").alias("file"), "grup_professional", "dni", "nom",
                       F.col("salari_mensual").cast("double").alias("salari_mensual"), F.col("nou_salari").cast("double").alias("nou_salari"))


@query("bundle_export", _PRICED + """
SELECT 'resumen_agregado' AS part, grup_professional AS grup, count(dni) AS n,
  CAST(round(CAST(avg(salari_mensual) AS DECIMAL(20,6)), 2) AS DOUBLE) AS salari
FROM priced WHERE grup_professional IS NOT NULL GROUP BY grup_professional
UNION ALL SELECT 'grups', grup_professional, 1, nou_salari FROM priced WHERE grup_professional IS NOT NULL""")
def q_bundle_export(spark, d):
    """SNK7/SNK8/PIP31: the summary file and the groups of one deliverable, as they are read back."""
    from tessera.sinks.writers import export_bundle
    priced = _priced(spark, d)
    root = export_bundle(E.group_summary(priced), priced.select("dni", "grup_professional", "nou_salari"), "grup_professional",
                         scratch_dir(spark, "bundle"))
    summary = spark.read.option("header", True).csv(f"{root}/resumen_agregado")
    groups = spark.read.option("header", True).csv(f"{root}/grups")
    one = F.lit(1).cast("bigint")
    return summary.select(F.lit("resumen_agregado").alias("part"), F.col("grup_professional").alias("grup"),
                          F.col("nombre_trabajador").cast("bigint").alias("n"), F.col("salari_mig").cast("double").alias("salari")).unionByName(
        groups.select(F.lit("grups").alias("part"), "grup", one.alias("n"), F.col("nou_salari").cast("double").alias("salari")))


@query("null_report", _PRICED + """
SELECT "column", nulls FROM (UNPIVOT (SELECT count(*) FILTER (WHERE salari_mensual IS NULL) AS salari_mensual,
  count(*) FILTER (WHERE "Cost_vida_index" IS NULL) AS "Cost_vida_index",
  count(*) FILTER (WHERE edad IS NULL) AS edad, count(*) FILTER (WHERE incremento_base IS NULL) AS incremento_base,
  count(*) FILTER (WHERE nou_salari IS NULL) AS nou_salari,
  count(*) FILTER (WHERE data_naixement IS NULL) AS data_naixement FROM priced)
  ON COLUMNS(*) INTO NAME "column" VALUE nulls) WHERE nulls > 0""")
def q_null_report(spark, d):
    from tessera.operators.profile import null_counts
    return null_counts(_priced(spark, d).select(
        "salari_mensual", "Cost_vida_index", "edad", "incremento_base", "nou_salari", "data_naixement"))


@query("gender_value_counts", "WITH " + S.CLEAN + """
SELECT genere AS value, count(*) AS freq FROM clean GROUP BY genere""")
def q_gender_counts(spark, d):
    from tessera.operators.relational import value_counts
    return value_counts(_clean(spark, d), "genere")


@query("group_share", "WITH " + S.CLEAN + """
SELECT grup_professional, count(*) AS n, count(*) / (SELECT count(*) FROM clean) AS share
FROM clean GROUP BY grup_professional""")
def q_group_share(spark, d):
    from tessera.operators.relational import share_of_rows
    return share_of_rows(_clean(spark, d), "grup_professional")


@query("gender_gap_by_country", "WITH " + S.CLEAN + """
SELECT pais_origen, CAST(round(CAST(avg(salari_mensual) FILTER (WHERE genere = 'Home') AS DECIMAL(20,6)), 2) AS DOUBLE) AS mean_a,
  CAST(round(CAST(avg(salari_mensual) FILTER (WHERE genere = 'Dona') AS DECIMAL(20,6)), 2) AS DOUBLE) AS mean_b,
  CAST(round(CAST(avg(salari_mensual) FILTER (WHERE genere = 'Home') - avg(salari_mensual) FILTER (WHERE genere = 'Dona') AS DECIMAL(20,6)), 2) AS DOUBLE) AS gap,
  CAST(round(CAST(avg(salari_mensual) FILTER (WHERE genere = 'Home') / avg(salari_mensual) FILTER (WHERE genere = 'Dona') AS DECIMAL(20,6)), 4) AS DOUBLE) AS ratio
FROM clean GROUP BY pais_origen""")
def q_gap(spark, d):
    from tessera.operators.relational import group_gap
    return group_gap(_clean(spark, d), "pais_origen", "genere", "Home", "Dona", "salari_mensual")


@query("salary_histogram", "WITH " + S.CLEAN + """
, b AS (SELECT min(salari_mensual) AS lo, max(salari_mensual) AS hi FROM clean)
SELECT CAST(coalesce(least(floor((salari_mensual - lo) / ((hi - lo) / 10)), 9), 0) AS INTEGER) AS bucket,
  count(*) AS freq, min(salari_mensual) AS lo_value, max(salari_mensual) AS hi_value
FROM clean, b WHERE salari_mensual IS NOT NULL GROUP BY 1""")
def q_hist(spark, d):
    from tessera.operators.relational import histogram
    return histogram(_clean(spark, d), "salari_mensual", 10)


def _profiled(dates, nums, texts, top=10, bins=10) -> str:
    """The profile table in SQL: top years, histograms, top values."""
    parts = [f"""(SELECT '{c}' AS "column", 'year' AS kind, CAST(year({c}) AS VARCHAR) AS bucket, count(*) AS freq FROM clean
      WHERE {c} IS NOT NULL GROUP BY 3 ORDER BY freq DESC, bucket LIMIT {top})""" for c in dates]
    parts += [f"""(SELECT '{c}', 'top_value', coalesce(CAST({c} AS VARCHAR), 'nan') AS bucket, count(*) AS freq FROM clean
      GROUP BY 3 ORDER BY freq DESC, bucket LIMIT {top})""" for c in texts]
    parts += [f"""(SELECT '{c}', 'histogram', printf('%02d', CAST(least(coalesce(floor((v - lo) / nullif((hi - lo) / {bins}, 0)), 0), {bins - 1}) AS INTEGER)),
      count(*) FROM (SELECT CAST({c} AS DOUBLE) AS v FROM clean WHERE {c} IS NOT NULL),
      (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM clean) GROUP BY 3)""" for c in nums]
    return " UNION ALL ".join(parts)


@query("employee_profile", "WITH " + S.CLEAN + "\n" + _profiled(
    ["data_naixement"], ["salari_mensual", "nombre_fills", "km_anuals", "consum_mitja_l_100km", "temperatura_mitjana_ciutat"],
    ["nom", "cognoms", "dni", "pais_origen", "ciutat", "genere", "grup_professional", "te_cotxe"]))
def q_profile(spark, d):
    from tessera.operators.profile import profile_table
    return profile_table(_clean(spark, d).drop("_ord"))


_SHEET_COLUMNS = ("Nom", "Cognoms", "DNI", "País d'origen", "Ciutat", "Dia de Naixement", "Mes de Naixement",
                  "Any de Naixement", "Gènere", "Salari mensual", "Fills", "No Fills", "Grup Professional",
                  "Nombre_fills", "Te_cotxe", "Km_anuals", "Consum_mitja_L_100km", "Temperatura_mitjana_ciutat")


@query("exploration_report", "WITH " + S.SHEET + """, s AS (SELECT * EXCLUDE (_ord) FROM sheet)
SELECT 'rows' AS metric, NULL::VARCHAR AS "column", count(*) AS value, NULL::VARCHAR AS text FROM s
UNION ALL SELECT 'columns', NULL, count(*), NULL FROM (DESCRIBE s)
UNION ALL SELECT 'duplicate_rows', NULL, (SELECT count(*) FROM s) - count(*), NULL FROM (SELECT DISTINCT * FROM s)
UNION ALL SELECT 'duplicate_keys', NULL, (SELECT count(*) FROM s) - count(*), NULL FROM (SELECT DISTINCT "DNI" FROM s)
""" + "".join(f"""UNION ALL SELECT 'non_null', '{c.replace("'", "''")}', count("{c}"), 'string' FROM s
""" for c in _SHEET_COLUMNS))
def q_explore(spark, d):
    from tessera.operators.profile import exploration_report
    return exploration_report(SV.survey_sheet(_t(spark, d)).drop("_ord"), "DNI")


def _described(num, txt) -> str:
    """Two-argument describe in SQL: numeric moments and quartiles, then counts of text."""
    parts = [f"""SELECT '{c}' AS "column", unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS stat,
      unnest([count({c})::DOUBLE, avg({c}), stddev({c}), min({c}), quantile_cont({c}, 0.25), quantile_cont({c}, 0.5),
      quantile_cont({c}, 0.75), max({c})]) AS value, NULL::VARCHAR AS text FROM clean""" for c in num]
    parts += [f"""SELECT '{c}', unnest(['count', 'unique', 'top', 'freq']),
      unnest([sum(n)::DOUBLE, count(*)::DOUBLE, NULL, max(n)::DOUBLE]), unnest([NULL, NULL, arg_min({c}, (-n, {c})), NULL])
      FROM (SELECT {c}, count(*) AS n FROM clean WHERE {c} IS NOT NULL GROUP BY 1)""" for c in txt]
    return 'SELECT "column", stat, round(value, 4) AS value, text FROM (' + " UNION ALL ".join(parts) + ")"


@query("describe_employees", "WITH " + S.CLEAN + _described(["salari_mensual", "km_anuals"], ["genere", "ciutat"]))
def q_describe(spark, d):
    from tessera.operators.profile import describe
    return describe(_clean(spark, d), ["salari_mensual", "km_anuals", "genere", "ciutat"]).withColumn(
        "value", F.round("value", 4))


# ================================================================== routes (PIP12)
@query("nearest_routes", """WITH RECURSIVE lanes AS (
  SELECT DISTINCT c_nationkey AS a, s_nationkey AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
named AS (SELECT a, b, x.n_name AS src, y.n_name AS dst,
  CASE WHEN a = b THEN 0.0 ELSE 50 + ((least(a, b) + 1) * (greatest(a, b) + 1) * 37 + (a + b) * 11) % 997 END::DOUBLE AS km
  FROM lanes JOIN nation x ON a = x.n_nationkey JOIN nation y ON b = y.n_nationkey),
edges AS (SELECT * FROM named WHERE src NOT IN ('NATION_23', 'NATION_24') AND dst NOT IN ('NATION_23', 'NATION_24')),
cities AS (SELECT src AS c FROM edges UNION SELECT dst FROM edges),
ways AS (SELECT src, dst, km, b AS ord FROM edges WHERE src <> dst),
walk(req_id, origin, destination, cur, path, total_km, status) AS (
  SELECT a * 1000 + b, src, dst, src, [src], 0.0::DOUBLE,
    CASE WHEN src NOT IN (FROM cities) OR dst NOT IN (FROM cities) THEN 'unknown city'
         WHEN src = dst THEN 'arrived' ELSE 'open' END FROM named
  UNION ALL
  SELECT req_id, origin, destination, coalesce(dst, cur), CASE WHEN dst IS NULL THEN path ELSE list_append(path, dst) END,
    total_km + coalesce(km, 0), CASE WHEN dst IS NULL THEN 'dead end' WHEN dst = destination THEN 'arrived' ELSE 'open' END
  FROM (SELECT w.*, e.dst, e.km, row_number() OVER (PARTITION BY req_id ORDER BY e.km NULLS LAST, e.ord) AS rn
        FROM walk w LEFT JOIN ways e ON w.cur = e.src AND NOT list_contains(w.path, e.dst) WHERE w.status = 'open') WHERE rn = 1)
SELECT req_id, origin, destination, CASE WHEN status <> 'unknown city' THEN array_to_string(path, ' -> ') END AS route,
  CASE WHEN status <> 'unknown city' THEN total_km END AS total_km,
  CASE WHEN status <> 'unknown city' THEN len(path) - 1 END::INTEGER AS steps,
  CASE WHEN status <> 'arrived' THEN status END AS error
FROM walk WHERE status <> 'open'""")
def q_routes(spark, d):
    from tessera.functions.arrays import join_list
    from tessera.operators.routes import greedy_routes
    from tessera.sources.lanes import lane_edges, lane_keys, route_requests
    t = _t(spark, d)
    lanes = lane_keys(t)
    out = greedy_routes(route_requests(t, lanes), lane_edges(t, lanes))
    return out.select("req_id", "origin", "destination", join_list(F.col("route")).alias("route"),
                      "total_km", "steps", "error")


# ================================================================== data quality (DQ1-DQ3)


@query("dq_lineitem_primary_key", """WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n,
  bool_or(l_orderkey IS NULL OR l_linenumber IS NULL) AS nul FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT count(*) FILTER (WHERE n > 1 AND NOT nul) AS duplicate_keys,
  CAST(coalesce(sum(n) FILTER (WHERE n > 1 AND NOT nul), 0) AS BIGINT) AS rows_in_duplicate_keys,
  CAST(coalesce(sum(n) FILTER (WHERE nul), 0) AS BIGINT) AS rows_with_null_key FROM g""")
def q_dq_pk(spark, d):
    return Q.primary_key_violations(_t(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


_NN = ("business_id", "product_ids", "amount", "declined", "user_id")


@query("dq_transactions_not_null", _V(t=M.TRANSACTIONS) + "SELECT \"column\", nulls FROM (SELECT "
       + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _NN)
       + " FROM t) UNPIVOT INCLUDE NULLS (nulls FOR \"column\" IN (" + ", ".join(_NN) + "))")
def q_dq_nn(spark, d):
    # the list is NULL where the order has no part key: their count tells, no list is built
    t = src.product_counts(_t(spark, d))
    return Q.not_null_violations(t.withColumn("product_ids", F.when(F.col("n_products") > 0, F.lit(""))), list(_NN))


@query("dq_transaction_orphans", _V(t=M.TRANSACTIONS, c=M.COMPANIES, u=M.USERS, k=M.CARDS) + """
SELECT 'business_id' AS fk, count(*) AS orphan_rows FROM t WHERE business_id IS NOT NULL
  AND business_id NOT IN (SELECT company_id FROM c)
UNION ALL SELECT 'user_id', count(*) FROM t WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM u)
UNION ALL SELECT 'card_id', count(*) FROM t WHERE card_id IS NOT NULL AND card_id NOT IN (SELECT card_id FROM k)""")
def q_dq_orphans(spark, d):
    t = _t(spark, d)
    return orphan_rows(src.transactions(t, False), _foreign_keys(t))


def _foreign_keys(t):
    return {"business_id": (src.companies(t), "company_id"), "user_id": (src.users(t), "user_id"),
            "card_id": (src.cards(t), "card_id")}


@query("dq_transaction_keys", _V(t=M.TRANSACTIONS, c=M.COMPANIES, u=M.USERS, k=M.CARDS) + """
SELECT 'business_id' AS fk, count(DISTINCT business_id) AS distinct_keys,
  count(DISTINCT business_id) FILTER (WHERE business_id NOT IN (SELECT company_id FROM c)) AS orphan_keys FROM t
UNION ALL SELECT 'user_id', count(DISTINCT user_id), count(DISTINCT user_id) FILTER (WHERE user_id NOT IN (SELECT user_id FROM u)) FROM t
UNION ALL SELECT 'card_id', count(DISTINCT card_id), count(DISTINCT card_id) FILTER (WHERE card_id NOT IN (SELECT card_id FROM k)) FROM t""")
def q_dq_keys(spark, d):
    t = _t(spark, d)
    return key_report(src.transactions(t, False), _foreign_keys(t))


# ================================================================== SNK4 streaming refresh
@query("daily_sales_streamed", _MV + "SELECT CAST(round(total_vendes, 2) AS DOUBLE) AS total_vendes, fecha FROM mv")
def q_streamed(spark, d):
    from tessera.streaming.daily_sales import refresh_daily_sales
    fact = scratch_dir(spark, "fact_stream")
    R.write_partitioned_fact(_recent(spark, d).drop("product_ids"), fact)
    schema = spark.read.parquet(fact).schema
    table, ck = scratch_dir(spark, "mv_daily_sales"), scratch_dir(spark, "mv_daily_sales_ckpt")
    refresh_daily_sales(spark, fact, table, ck, schema)
    return R.daily_sales_report(spark.read.parquet(table))


from tessera.plans import registry_tables  # noqa: E402, F401  (registers its queries here)
