"""The retail model of ``tessera.sources.retail`` written as plain SQL views
(DuckDB dialect), used by the independent oracle queries.  Kept textually
separate from the Spark code on purpose: it is the second implementation.
"""

GEO = """SELECT n_nationkey, n_name AS country, r_name AS region
FROM nation JOIN region ON n_regionkey = r_regionkey"""

COMPANIES = f"""SELECT s_suppkey AS company_id, s_name AS company_name,
 '+' || CAST(s_nationkey AS VARCHAR) || '-' || CAST(s_suppkey AS VARCHAR) AS phone,
 'company' || CAST(s_suppkey AS VARCHAR) || '@mail.test' AS email,
 g.country, g.region AS continent
FROM supplier JOIN ({GEO}) g ON s_nationkey = g.n_nationkey"""

TRANSACTIONS = """SELECT o.o_orderkey AS transaction_id, o.o_custkey AS card_id, l.business_id,
 o.o_orderdate AS "timestamp", CAST(o.o_totalprice AS DECIMAL(12,2)) AS amount,
 o.o_orderstatus = 'F' AS declined, l.product_ids, o.o_custkey AS user_id
FROM orders o LEFT JOIN (
  SELECT l_orderkey, min(l_suppkey) AS business_id,
         string_agg(CAST(l_partkey AS VARCHAR), ', ' ORDER BY l_partkey) AS product_ids
  FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey"""

USERS_BASE = f"""SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS surname,
 '+' || CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) AS phone,
 'user' || CAST(c_custkey AS VARCHAR) || '@mail.test' AS email, g.country, g.region
FROM customer JOIN ({GEO}) g ON c_nationkey = g.n_nationkey"""

USERS = f"""SELECT user_id, name, surname, phone, email, country, 'America' AS origin
FROM ({USERS_BASE}) WHERE region = 'AMERICA'
UNION ALL
SELECT user_id, name, surname, phone, email, country, 'Europe' AS origin
FROM ({USERS_BASE}) WHERE region = 'EUROPE'"""

CARDS = """SELECT c_custkey AS card_id, c_custkey AS user_id,
 'XX' || lpad(CAST(c_custkey AS VARCHAR), 20, '0') AS iban FROM customer"""

PRODUCTS = """SELECT p_partkey AS product_id, p_name AS name, p_retailprice AS price,
 split_part(p_name, ' ', 1) AS colour, p_type AS category, p_brand AS brand,
 'WH-' || CAST(p_size AS VARCHAR) AS warehouse_id FROM part"""

SILVER_PRODUCTS = f"""SELECT product_id, name, price, colour,
 TRY_CAST(substr(warehouse_id, 4) AS BIGINT) AS warehouse_id, category, brand
FROM ({PRODUCTS})"""

RAW = f"""SELECT CAST(transaction_id AS VARCHAR) AS id, CAST(card_id AS VARCHAR) AS card_id,
 CAST(business_id AS VARCHAR) AS business_id, CAST("timestamp" AS VARCHAR) AS "timestamp",
 CAST(amount AS VARCHAR) AS amount, CASE WHEN declined THEN '1' ELSE '0' END AS declined,
 product_ids, CAST(user_id AS VARCHAR) AS user_id
FROM ({TRANSACTIONS})"""

SILVER_TRANSACTIONS = f"""SELECT id AS transaction_id, card_id, business_id,
 TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp",
 coalesce(TRY_CAST(amount AS DOUBLE), 0.0) AS amount, declined, product_ids, user_id
FROM ({RAW})"""


def recent(as_of: str, span: int = 50) -> str:
    """PIP13 re-dated silver transactions (product list kept as text)."""
    return f"""SELECT transaction_id, card_id, business_id, amount, declined, product_ids, user_id,
 TIMESTAMP '{as_of}' - to_days(CAST(CAST(transaction_id AS BIGINT) % {span + 1} AS INTEGER)) AS "timestamp"
FROM ({SILVER_TRANSACTIONS})"""


def with_views(**views: str) -> str:
    """``WITH name AS (…), …`` prefix."""
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in views.items()) + "\n"


def mean_money(x: str, over: str = "") -> str:
    """Mean of a money column rounded half-up to cents, computed exactly in
    integer cents (DuckDB's decimal division yields a double)."""
    cents = f"CAST(round(sum(CAST({x} AS DECIMAL(18,2))){over} * 100) AS HUGEINT)"
    n = f"count({x}){over}"
    return f"(CAST((2 * {cents} + {n}) // (2 * {n}) AS DOUBLE) / 100)"
