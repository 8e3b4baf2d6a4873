"""Retail-payments model over the driver tables.

| model            | driver tables                                   |
| ---------------- | ----------------------------------------------- |
| companies        | supplier + nation (country) + region (continent)|
| transactions     | orders; company = lowest supplier of the order's|
|                  | lines, products = the order's part keys          |
| users            | customer of region AMERICA / EUROPE, re-unioned |
| credit cards     | one card per customer                           |
| products         | part                                            |

Money stays ``decimal(12,2)`` so sums are exact.  The transaction's line
aggregation is one partial+final hash aggregate keyed by ``l_orderkey``;
when a query does not read ``product_ids`` Catalyst prunes the list build.
Nation/region are joined without hints: they are tiny, and Spark's size
statistics pick the broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import id_list
from tessera.functions.dates import mysql_short_date
from tessera.functions.text import substr_from
from tessera.sources.tables import Tables

#: Rows of order lines and orders that one task joins (see ``transaction_lines``).
ROWS_A_TASK = 250_000


def _geo(t: Tables) -> DataFrame:
    n, r = t.nation, t.region
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("region"))


def companies(t: Tables) -> DataFrame:
    """company_id, company_name, phone, email, country, continent."""
    s = t.supplier
    return s.join(_geo(t), s.s_nationkey == F.col("n_nationkey")).select(
        s.s_suppkey.alias("company_id"),
        s.s_name.alias("company_name"),
        F.concat(F.lit("+"), s.s_nationkey.cast("string"), F.lit("-"),
                 s.s_suppkey.cast("string")).alias("phone"),
        F.concat(F.lit("company"), s.s_suppkey.cast("string"), F.lit("@mail.test")).alias("email"),
        F.col("country"),
        F.col("region").alias("continent"),
    )


def order_lines(t: Tables, with_products: bool = True) -> DataFrame:
    """Per order: business (lowest supplier key), the number of its part keys and their sorted list.

    The list is bounded by the lines of one order; it is the transaction's
    own ``product_ids`` field, not a collected group of many rows.  An order
    without a part key has no list (NULL).
    """
    aggs = [F.min("l_suppkey").alias("business_id"), F.count("l_partkey").alias("n_products")]
    if with_products:
        listed = F.array_join(
            F.transform(F.sort_array(F.collect_list("l_partkey")), lambda x: x.cast("string")), ", ")
        aggs.append(F.when(F.count("l_partkey") > 0, listed).alias("product_ids"))
    return t.lineitem.groupBy("l_orderkey").agg(*aggs)


def line_products(t: Tables) -> DataFrame:
    """(transaction, product occurrence) of every order line, for joins that look up the order anyway."""
    return t.lineitem.select(F.col("l_orderkey").alias("transaction_id"), F.col("l_partkey").alias("product_id"))


def product_counts(t: Tables) -> DataFrame:
    """Transactions with ``n_products`` instead of the list: the list is NULL exactly where it is NULL or 0."""
    return _transactions(t, False, "n_products")


def transaction_lines(t: Tables) -> DataFrame:
    """The unnested form of ``product_ids``: one row per (transaction,
    product occurrence), i.e. the order lines of existing orders.

    Queries that only unnest the list read this directly, so no per-order
    list is ever collected.  Both sides are dealt by transaction into a number
    of parts that follows their rows (counted from the Parquet footers): left
    to itself, AQE joins small parts until each core has one, and the sort of
    a part, and what a caller keeps per transaction, grow with the input.
    The keys are made distinct for an inner join, as a semi join would be
    pushed below the lines' repartition and deal them twice.
    """
    li = line_products(t)
    o = t.orders.select(F.col("o_orderkey").alias("_o"))
    parts = (li.count() + o.count()) // ROWS_A_TASK + 1
    return li.repartition(parts, "transaction_id").join(
        o.repartition(parts, "_o").distinct(), F.col("transaction_id") == F.col("_o")).drop("_o")


def transactions(t: Tables, with_products: bool = True) -> DataFrame:
    """Typed transactions (MySQL-level model).

    transaction_id, card_id, business_id, timestamp, amount decimal(12,2),
    declined boolean (status 'F'), product_ids text ``'3, 5, 5'``, user_id.
    Orders without lines keep NULL business and products.
    """
    return _transactions(t, with_products, *(["product_ids"] if with_products else []))


def _transactions(t: Tables, with_products: bool, *more: str) -> DataFrame:
    o = t.orders
    lines = order_lines(t, with_products)
    cols = [o.o_orderkey.alias("transaction_id"),
            o.o_custkey.alias("card_id"),
            F.col("business_id"),
            o.o_orderdate.alias("timestamp"),
            o.o_totalprice.cast("decimal(12,2)").alias("amount"),
            (o.o_orderstatus == F.lit("F")).alias("declined")]
    cols += [F.col(c) for c in more]
    cols.append(o.o_custkey.alias("user_id"))
    return o.join(lines, o.o_orderkey == lines.l_orderkey, "left").select(*cols)


def transactions_raw_without_products(t: Tables) -> DataFrame:
    """Bronze columns without the product list (its unnested form is
    ``transaction_lines``)."""
    return transactions_raw(t, with_products=False)


def transactions_raw(t: Tables, with_products: bool = True) -> DataFrame:
    """Bronze: the same rows with every column as text (SRC6 layout).

    declined is ``'0'``/``'1'``; timestamp ``yyyy-MM-dd HH:mm:ss``.
    """
    x = transactions(t, with_products)
    if not with_products:
        x = x.withColumn("product_ids", F.lit(None).cast("string"))
    return x.select(
        x.transaction_id.cast("string").alias("id"),
        x.card_id.cast("string").alias("card_id"),
        x.business_id.cast("string").alias("business_id"),
        x.timestamp.cast("string").alias("timestamp"),
        x.amount.cast("string").alias("amount"),
        F.when(x.declined, F.lit("1")).otherwise(F.lit("0")).alias("declined"),
        x.product_ids,
        x.user_id.cast("string").alias("user_id"),
    )


def transactions_silver(raw: DataFrame) -> DataFrame:
    """PIP11 (transactions): bronze text → typed silver.

    ``SAFE_CAST`` → ``try_cast``; ``IFNULL(amount, 0)``; product list →
    ``array<bigint>`` keeping bad elements as NULL (ARR1); declined stays
    the text flag as in the silver layer of the reference.
    """
    return raw.select(
        F.col("id").alias("transaction_id"),
        "card_id",
        "business_id",
        F.col("timestamp").try_cast("timestamp_ntz").alias("timestamp"),
        F.coalesce(F.col("amount").try_cast("double"), F.lit(0.0)).alias("amount"),
        "declined",
        id_list(F.col("product_ids")).alias("product_ids"),
        "user_id",
    )


def users(t: Tables) -> DataFrame:
    """SET1/PRJ3: american and european users unioned with an origin tag."""
    c = t.customer
    base = c.join(_geo(t), c.c_nationkey == F.col("n_nationkey")).select(
        c.c_custkey.alias("user_id"),
        c.c_name.alias("name"),
        c.c_mktsegment.alias("surname"),
        F.concat(F.lit("+"), c.c_nationkey.cast("string"), F.lit("-"),
                 c.c_custkey.cast("string")).alias("phone"),
        F.concat(F.lit("user"), c.c_custkey.cast("string"), F.lit("@mail.test")).alias("email"),
        F.col("country"),
        F.col("region"),
    )
    american = base.filter(F.col("region") == "AMERICA").drop("region") \
        .withColumn("origin", F.lit("America"))
    european = base.filter(F.col("region") == "EUROPE").drop("region") \
        .withColumn("origin", F.lit("Europe"))
    return american.unionByName(european)


def cards(t: Tables) -> DataFrame:
    """One card per customer; expiry given as ``MM/dd/yy`` text (SRC4)."""
    c = t.customer
    k = c.c_custkey
    txt = F.concat_ws("/", F.lpad((F.pmod(k, F.lit(12)) + 1).cast("string"), 2, "0"),
                      F.lpad((F.pmod(k, F.lit(28)) + 1).cast("string"), 2, "0"),
                      F.lpad(F.pmod(k * 7, F.lit(100)).cast("string"), 2, "0"))
    return c.select(k.alias("card_id"), k.alias("user_id"),
                    F.concat(F.lit("XX"), F.lpad(k.cast("string"), 20, "0")).alias("iban"),
                    mysql_short_date(txt).alias("expiring_date"))


def products(t: Tables) -> DataFrame:
    """product_id, name, price (double), colour, category, brand, warehouse_id text."""
    p = t.part
    return p.select(p.p_partkey.alias("product_id"), p.p_name.alias("name"),
                    p.p_retailprice.alias("price"),
                    F.substring_index(p.p_name, " ", 1).alias("colour"),
                    p.p_type.alias("category"), p.p_brand.alias("brand"),
                    F.concat(F.lit("WH-"), p.p_size.cast("string")).alias("warehouse_id"))


def products_silver(raw: DataFrame) -> DataFrame:
    """PIP11 (products): rename + ``SAFE_CAST(SUBSTR(warehouse_id, 4) AS INT64)``."""
    return raw.select(F.col("product_id"), F.col("name"), "price", "colour",
                      substr_from(F.col("warehouse_id"), 4).try_cast("bigint").alias("warehouse_id"),
                      "category", "brand")
