"""Retail-payments analytics (PIP1-PIP21).

Each function takes model DataFrames (see ``tessera.sources.retail``) and
returns a lazy DataFrame; nothing is collected.  Money thresholds are
parameters: the defaults are the reference's euro values, and callers on
the driver tables (amount = order total) pass values scaled to that data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.arrays import id_items, id_set_text
from tessera.functions.dates import reverse_date_text
from tessera.functions.numeric import calculate_tax, key_day_offset, pct_change
from tessera.operators.ordinals import in_range_order
from tessera.operators.scans import lag_of, running_sum_of


def _accepted(t: DataFrame) -> DataFrame:
    return t.filter(~F.col("declined"))


def _money(c) -> F.Column:
    return F.round(c, 2).cast("double")


def _exact(c) -> F.Column:
    """Money as exact decimal: sums and means do not depend on row order."""
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def _sales(companies: DataFrame, transactions: DataFrame) -> DataFrame:
    """JN1: fact × dimension on the company key (row-level result)."""
    return companies.join(transactions, companies.company_id == transactions.business_id)


def _per_company(companies: DataFrame, transactions: DataFrame) -> DataFrame:
    """Pre-aggregate the fact per business key *before* the join.

    Catalyst does not push aggregates below joins, so without this the
    whole fact would be shuffled to meet the company dimension.  Here each
    map task first collapses its rows to one per company (a hot company
    costs one row per task), then only those partial sums cross the
    network; sums stay exact in decimal and means are ``sum / count``.
    """
    per = transactions.groupBy("business_id").agg(
        F.sum(_exact("amount")).alias("_sum"), F.count("amount").alias("_n_amount"),
        F.count("transaction_id").alias("_n_tx"))
    return companies.join(per, companies.company_id == per.business_id)


# ---------------------------------------------------------------- PIP1 / PIP2 / PIP3 / PIP4
def countries_with_sales(companies: DataFrame, transactions: DataFrame) -> DataFrame:
    """PIP1a: one country row per accepted sale (no DISTINCT), sorted.

    The unique transaction id is a secondary sort key: range partitioning
    cannot split equal keys, so without it a country holding a third of the
    sales would land in one sort task.
    """
    return _sales(companies, _accepted(transactions)).orderBy("country", "transaction_id").select("country")


def count_sales_countries(companies: DataFrame, transactions: DataFrame) -> DataFrame:
    """PIP1b/AGG1: exact ``COUNT(DISTINCT country)`` of accepted sales."""
    return _per_company(companies, _accepted(transactions)).agg(
        F.count_distinct("country").alias("n_countries"))


def top_company_by_mean_sale(companies: DataFrame, transactions: DataFrame, k: int = 1) -> DataFrame:
    """PIP1c/AGG2/SRT3: company with the highest rounded mean accepted sale."""
    g = _per_company(companies, _accepted(transactions)).groupBy("company_name").agg(
        _money(F.sum("_sum") / F.sum("_n_amount")).alias("mitja_superior_vendes"))
    return g.orderBy(F.desc("mitja_superior_vendes"), "company_name").limit(k)


def transactions_of_country(companies: DataFrame, transactions: DataFrame, country: str) -> DataFrame:
    """PIP2a/JN5: ``WHERE company_id IN (SELECT id … WHERE country = ?)``."""
    ids = companies.filter(F.col("country") == country).select("company_id")
    return transactions.join(ids, transactions.business_id == ids.company_id, "left_semi")


def transactions_if_country_exists(companies: DataFrame, transactions: DataFrame,
                                   country: str) -> DataFrame:
    """JN7: *uncorrelated* EXISTS — every accepted transaction when any company
    of the country exists, none otherwise.  Planned as one scalar subquery
    evaluated once (no join)."""
    flag = companies.filter(F.col("country") == country).exists()
    return _accepted(transactions).filter(flag)


def companies_above_mean(companies: DataFrame, transactions: DataFrame) -> DataFrame:
    """PIP2b/JN6/AGG3: companies with a transaction above the global mean.

    The mean is a scalar subquery (one global aggregate), then a semi-join."""
    mean = transactions.select(F.avg("amount")).scalar()
    ids = transactions.filter(F.col("amount") > mean).select("business_id").distinct()
    return companies.join(ids, companies.company_id == ids.business_id, "left_semi") \
        .select("company_name")


def companies_without_transactions(companies: DataFrame, transactions: DataFrame) -> DataFrame:
    """PIP2c/JN9: ``NOT EXISTS`` → left anti join with the distinct keys, so
    that a hot company is one row per task before the shuffle."""
    ids = transactions.select("business_id").distinct()
    return companies.join(ids, companies.company_id == ids.business_id, "left_anti")


def users_without_transactions(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """JN9 on the second foreign key."""
    ids = transactions.select(F.col("user_id").alias("_u")).distinct()
    return users.join(ids, users.user_id == ids._u, "left_anti")


def frequent_users(users: DataFrame, transactions: DataFrame, min_count: int = 80) -> DataFrame:
    """PIP3/JN8: users with more than ``min_count`` transactions.

    Correlated ``EXISTS (… GROUP BY … HAVING COUNT > n)`` → partial/final
    aggregate on user then semi-join."""
    busy = transactions.groupBy("user_id").agg(F.count("transaction_id").alias("n")) \
        .filter(F.col("n") > min_count).select(F.col("user_id").alias("_uid"))
    return users.join(busy, users.user_id == busy._uid, "left_semi")


def mean_spend_per_card_at_company(cards: DataFrame, transactions: DataFrame,
                                   companies: DataFrame, company_name: str) -> DataFrame:
    """PIP4/JN2: mean spend per card IBAN at one company (filtered dimension first)."""
    c = companies.filter(F.col("company_name") == company_name).select("company_id")
    t = transactions.join(c, transactions.business_id == c.company_id, "left_semi")
    per = t.groupBy("card_id").agg(F.sum(_exact("amount")).alias("_sum"), F.count("amount").alias("_n"))
    return cards.join(per, cards.card_id == per.card_id).groupBy("iban").agg(
        _money(F.sum("_sum") / F.sum("_n")).alias("media_gasto"))


# ---------------------------------------------------------------- PIP5 / PIP6 / PIP7 / PIP8
def best_sales_days(transactions: DataFrame, k: int = 5) -> DataFrame:
    """PIP5a/AGG10/AGG4/SRT3: top-k days by total sales (all transactions)."""
    g = transactions.groupBy(F.to_date("timestamp").alias("fechas_ventas")).agg(
        F.sum("amount").cast("double").alias("total_ventas"))
    return g.orderBy(F.desc("total_ventas"), "fechas_ventas").limit(k)


def daily_sales_of_year_raw(raw: DataFrame, year: str, k: int = 5) -> DataFrame:
    """PIP5b/FLT6/STR1/CST1 on the all-text bronze table: accepted sales by
    day of one year, top-k.  The text prefix filter cannot reach the Parquet
    scan, as in the reference; the silver table filters on a typed date."""
    g = raw.filter((F.substring("timestamp", 1, 4) == year) & (F.col("declined") == "0")) \
        .groupBy(F.substring("timestamp", 1, 10).alias("date")) \
        .agg(_money(F.sum(F.col("amount").cast("decimal(18,2)"))).alias("total_amount"))
    return g.orderBy(F.desc("total_amount"), "date").limit(k)


def companies_in_band_on_days(companies: DataFrame, transactions: DataFrame, lo, hi,
                              days: Sequence[str]) -> DataFrame:
    """PIP6/FLT2/FLT3: sales with amount in ``[lo, hi]`` on given days."""
    t = transactions.filter(F.col("amount").between(lo, hi)
                            & F.to_date("timestamp").isin([F.lit(d).cast("date") for d in days]))
    return _sales(companies, t).select(
        "company_name", "phone", "country",
        F.to_date("timestamp").alias("fecha_transaccion"), "amount").orderBy(F.desc("amount"))


def companies_in_band_on_days_raw(companies: DataFrame, raw: DataFrame, lo, hi,
                                  days_dmy: Sequence[str]) -> DataFrame:
    """PIP6 (bronze)/DAT2: day-first text date, filtered and sorted as text."""
    t = raw.withColumn("fecha_inversa", reverse_date_text(F.col("timestamp"))) \
        .filter((F.col("declined") == "0")
                & F.col("amount").cast("double").between(lo, hi)
                & F.col("fecha_inversa").isin(list(days_dmy)))
    c = companies.select(F.col("company_id").cast("string").alias("_cid"), "company_name", "country")
    # a handful of distinct days: the id tiebreak lets range partitioning split them
    return c.join(t, c._cid == t.business_id).orderBy("fecha_inversa", "id").select(
        "company_name", "country", "fecha_inversa")


def capacity_band(companies: DataFrame, transactions: DataFrame, threshold: int = 400) -> DataFrame:
    """PIP7/AGG9: transactions per company and a band on the count."""
    g = _per_company(companies, transactions).groupBy("company_name").agg(
        F.sum("_n_tx").alias("total_transacciones"))
    return g.withColumn("capacidad_operativa", F.when(
        F.col("total_transacciones") >= threshold, F.lit(f"{threshold} o més transaccions"))
        .otherwise(F.lit(f"Menys de {threshold} transaccions"))).orderBy("total_transacciones")


def marketing_tiers(companies: DataFrame, transactions: DataFrame, premium_above=260) -> DataFrame:
    """PIP8/AGG2/AGG9/SRT2: mean accepted sale per company and its tier.

    The tier tests the *unrounded* mean, the shown mean is rounded.
    """
    g = _per_company(companies, _accepted(transactions)) \
        .groupBy("company_name", "phone", "country") \
        .agg((F.sum("_sum") / F.sum("_n_amount")).alias("_mean"))
    return g.select("company_name", "phone", "country",
                    _money(F.col("_mean")).alias("mitja_compra"),
                    F.when(F.col("_mean") > premium_above, F.lit("Premium"))
                    .otherwise(F.lit("Standard")).alias("client_tier")) \
        .orderBy(F.asc("client_tier"), F.desc("mitja_compra"))


# ---------------------------------------------------------------- PIP9 / PIP10
def active_cards(transactions: DataFrame, last_n: int = 3, order_col: str | None = None) -> DataFrame:
    """PIP9/WIN1/AGG7: cards with any accepted transaction among their last
    ``last_n``; "last" is by transaction id *text*, descending, as in the
    reference (``order_col`` overrides).

    ``row_number() <= n`` is planned as a WindowGroupLimit, so a hot card is
    cut to ``n`` rows per map partition before the shuffle.
    """
    order = F.col(order_col) if order_col else F.col("transaction_id").cast("string")
    w = Window.partitionBy("card_id").orderBy(order.desc())
    last = transactions.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= last_n)
    per_card = last.groupBy("card_id").agg(F.count_if(~F.col("declined")).alias("_ok"))
    return per_card.filter(F.col("_ok") > 0).agg(F.count("*").alias("total_tarjetas_activas"))


def product_sales_membership(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """PIP10a/JN12/STR4/STR5: ``ON FIND_IN_SET(p.id, REPLACE(ids,' ','')) > 0``.

    Rewritten from a nested-loop theta join to explode + equi-join; the set is
    de-duplicated per transaction because FIND_IN_SET matches once.
    """
    members = transactions.select(F.explode(id_set_text(F.col("product_ids"))).alias("_pid")) \
        .groupBy("_pid").agg(F.count("*").alias("_n"))  # pre-aggregated per member
    p = products.select(F.col("product_id").alias("id"), F.col("name").alias("product_name"),
                        F.col("product_id").cast("string").alias("_pid"))
    return p.join(members, "_pid").groupBy("id", "product_name") \
        .agg(F.sum("_n").alias("veces_vendido")).orderBy("id")


def product_sales_ranking(products_silver: DataFrame, transactions_silver: DataFrame) -> DataFrame:
    """PIP10b/JN3/JN10: every product with its unnested sale count, zeros kept
    (left join + ``COUNT(right key)``); repeats within a transaction count."""
    flat = transactions_silver.select(id_items(transactions_silver, "product_ids").alias("_item")) \
        .select(F.col("_item").try_cast("bigint").alias("id_aplanado")).groupBy("id_aplanado").agg(F.count("id_aplanado").alias("_n"))  # pre-aggregated per id
    p = products_silver
    return p.join(flat, p.product_id == flat.id_aplanado, "left") \
        .groupBy("product_id", "name", "price", "colour") \
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_sold")).orderBy(F.desc("total_sold"))


def product_sales_membership_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """PIP10a/JN12 on the unnested form ``(transaction_id, product_id)``:
    a product counts once per transaction (distinct pairs), as FIND_IN_SET.
    Distinct and count are partial aggregates; nothing is collected.  Lines
    dealt by transaction, as ``transaction_lines`` gives them, are not dealt
    anew for the distinct pairs."""
    per = lines.select("transaction_id", "product_id").distinct() \
        .groupBy("product_id").agg(F.count("*").alias("veces_vendido"))
    p = products.select(F.col("product_id").alias("id"), F.col("name").alias("product_name"))
    return p.join(per, p.id == per.product_id).select("id", "product_name", "veces_vendido").orderBy("id")


def product_sales_ranking_lines(products_silver: DataFrame, lines: DataFrame) -> DataFrame:
    """PIP10b/JN3/JN10 on the unnested form: every occurrence counts
    (repeats included), products never sold keep 0."""
    per = lines.groupBy(F.col("product_id").alias("id_aplanado")).agg(F.count("*").alias("_n"))
    p = products_silver
    return p.join(per, p.product_id == per.id_aplanado, "left") \
        .select("product_id", "name", "price", "colour", F.coalesce("_n", F.lit(0)).alias("total_sold")) \
        .orderBy(F.desc("total_sold"))


def flat_sales_lines(transactions_silver: DataFrame, lines: DataFrame, products_silver: DataFrame,
                     accepted_only: bool = True, with_tax: bool = True) -> DataFrame:
    """PIP20/JN11/UDF1 on the unnested form: transaction × its product
    occurrences × product, same columns as ``flat_sales``."""
    t = transactions_silver
    if accepted_only:
        t = t.filter(F.col("declined") == "0")
    t = t.select("transaction_id", "timestamp", F.col("amount").alias("total_ticket"))
    # the large side keeps its numeric key; the text key of the transactions is read as a number
    ln = lines.select(F.col("transaction_id").alias("_t"), F.col("product_id").alias("product_sku"))
    flat = t.join(ln, t.transaction_id.try_cast("bigint") == ln._t).drop("_t")
    p = products_silver
    cols = ["transaction_id", "timestamp", "total_ticket", "product_sku",
            p.name.alias("product_name"), p.price.alias("product_price")]
    if with_tax:
        cols.append(calculate_tax(p.price).alias("producto_price_tax_inc"))
    cols.append(p.category)
    return flat.join(p, flat.product_sku == p.product_id).select(*cols)


# ---------------------------------------------------------------- PIP13-PIP15
def redate(transactions_silver: DataFrame, as_of: str, span: int = 50,
           key: str = "transaction_id") -> DataFrame:
    """PIP13/MTH9/DAT4: move every transaction into the last ``span`` days
    before ``as_of`` with a key-derived (repeatable) offset."""
    ts = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(days=key_day_offset(F.col(key), span))
    return transactions_silver.drop("timestamp").withColumn("timestamp", ts)


def write_partitioned_fact(df: DataFrame, path: str, cluster_by: str = "business_id") -> str:
    """SNK2: ``PARTITION BY DATE(timestamp) CLUSTER BY business_id``.

    The rebalance puts a day's rows together and splits a day that is larger
    than the advisory partition size into several files; the sort within
    partitions clusters by company so Parquet row-group min/max statistics
    skip other companies.
    """
    out = df.withColumn("date", F.to_date("timestamp"))
    (out.hint("rebalance", F.col("date")).sortWithinPartitions("date", cluster_by)
        .write.mode("overwrite").partitionBy("date").parquet(path))
    return path


def recent_days(fact: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """PIP14/FLT5: rows of the last ``days`` days; on the partitioned fact the
    predicate is on the partition column, so directories are pruned."""
    return fact.filter(F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days))


def daily_sales(fact: DataFrame) -> DataFrame:
    """SNK4: the materialised daily totals (``total_vendes``, ``fecha``)."""
    return fact.groupBy(F.col("date").alias("fecha")).agg(F.sum(_exact("amount")).alias("total_vendes"))


def daily_sales_report(mv: DataFrame) -> DataFrame:
    """PIP15: rounded daily totals, newest first."""
    return mv.select(_money(F.col("total_vendes")).alias("total_vendes"), "fecha") \
        .orderBy(F.desc("fecha"))


# ---------------------------------------------------------------- PIP16-PIP19
def vip_customers(transactions: DataFrame, users: DataFrame, min_total=500) -> DataFrame:
    """PIP16/AGG8/STR3: accepted spend per user, kept above ``min_total``
    (tested on the *rounded* sum, like the HAVING on the alias)."""
    t = transactions.filter(F.col("declined") == "0").groupBy(F.col("user_id").alias("_u")).agg(
        F.sum(_exact("amount")).alias("_sum"), F.count("amount").alias("_n_amount"),
        F.count("transaction_id").alias("num_compres"), F.max("amount").alias("compra_maxima"))
    g = t.join(users, t._u == users.user_id.cast("string")).select(
        users.user_id, "name", "surname", "email",
        _money(F.col("_sum")).alias("total_gastat"), "num_compres",
        _money(F.col("_sum") / F.col("_n_amount")).alias("tiquet_mitja"), "compra_maxima")
    return g.filter(F.col("total_gastat") > min_total).select(
        "user_id", F.concat("name", F.lit(" "), "surname").alias("nom_complet"), "email",
        "total_gastat", "num_compres", "tiquet_mitja", "compra_maxima") \
        .orderBy(F.desc("total_gastat"))


def day_over_day(mv: DataFrame) -> DataFrame:
    """PIP17/WIN3/MTH4: previous day's total and the % change.

    ``LAG`` without partition runs in one task; its input is one row per day.
    """
    w = Window.orderBy("fecha")
    h = mv.select("fecha", "total_vendes", F.lag("total_vendes").over(w).alias("_prev"))
    return h.select(F.col("fecha").alias("Data"),
                    _money(F.col("total_vendes")).alias("Vendes_Avui"),
                    _money(F.col("_prev")).alias("Vendes_Ahir"),
                    pct_change(F.col("total_vendes"), F.col("_prev")).cast("double")
                    .alias("Diff_Percentual")).orderBy("Data")


def year_to_date(mv: DataFrame) -> DataFrame:
    """PIP18/WIN4: running sum of the *rounded* daily totals within the year."""
    day = mv.select(F.col("fecha").alias("Data"), F.round("total_vendes", 2).alias("Vendes_del_Dia"))
    w = Window.partitionBy(F.year("Data")).orderBy("Data") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return day.select("Data", F.col("Vendes_del_Dia").cast("double").alias("Vendes_del_Dia"),
                      F.round(F.sum("Vendes_del_Dia").over(w), 2).cast("double")
                      .alias("Vendes_Acumulades_YTD")).orderBy("Data")


def transaction_changes(transactions: DataFrame) -> DataFrame:
    """WIN3/WIN4/MTH4 over every transaction, not only over days: the change against the previous one,
    the running total, and the running total of the year.  One order serves all three, and no
    window is without partitions (``operators.scans``)."""
    t = transactions.select("transaction_id", "timestamp", "amount", F.year("timestamp").alias("_year"))
    lagged = lag_of(in_range_order(t, ["timestamp", "transaction_id"], "changes"), {"previous_amount": "amount"})
    total = running_sum_of(lagged, "amount", "running_total")
    yearly = running_sum_of(total, "amount", "year_total", by="_year")  # a year's rows follow each other
    before = F.col("previous_amount").cast("double")
    return yearly.select(
        "transaction_id", "timestamp", F.col("amount").cast("double").alias("amount"), before.alias("previous_amount"),
        F.round(F.try_divide(F.col("amount").cast("double") - before, F.nullif(before, F.lit(0.0))) * 100, 2).alias("diff_percent"),
        F.col("running_total").cast("double").alias("running_total"), F.col("year_total").cast("double").alias("year_total"))


def third_purchase(users: DataFrame, transactions: DataFrame, nth: int = 3) -> DataFrame:
    """PIP19/WIN2/WIN5: each user's ``nth`` accepted purchase and the running
    mean up to it (default RANGE frame: purchases at the same instant count).

    Plan: a rank-only window (``row_number() = n`` → WindowGroupLimit, so at
    most ``n`` rows per user leave each map task), then the running mean as
    an aggregate of the user's purchases up to that instant.  No window holds
    a whole user's history, so a hot user does not pin one task.
    """
    t = transactions.filter(F.col("declined") == "0").select(
        "transaction_id", "user_id", "timestamp", "amount")
    w = Window.partitionBy("user_id").orderBy("timestamp", "transaction_id")
    nth_row = t.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == nth) \
        .select(F.col("user_id").alias("_u"), F.col("timestamp").alias("data_3a_compra"),
                F.col("amount").alias("import_3a_compra"))
    # the history is one row per user and instant before it meets the rank row
    at = t.groupBy("user_id", "timestamp").agg(F.sum(_exact("amount")).alias("_sum"), F.count("amount").alias("_n"))
    upto = at.join(nth_row, (at.user_id == nth_row._u) & (at.timestamp <= nth_row.data_3a_compra)) \
        .groupBy("_u").agg((F.sum("_sum") / F.sum("_n")).alias("_mean"))
    u = users.select("user_id", F.concat("name", F.lit(" "), "surname").alias("nom_complet"), "email")
    return u.join(nth_row, u.user_id.cast("string") == nth_row._u).join(upto, "_u").select(
        "user_id", "nom_complet", "email", _money(F.col("_mean")).alias("compra_media"),
        "import_3a_compra", "data_3a_compra")


# ---------------------------------------------------------------- PIP20 / PIP21
def flat_sales(transactions_silver: DataFrame, products_silver: DataFrame,
               accepted_only: bool = True, with_tax: bool = True) -> DataFrame:
    """PIP20/JN11/UDF1: one row per (transaction, product occurrence); the list is an array or text."""
    t = transactions_silver
    if accepted_only:
        t = t.filter(F.col("declined") == "0")
    flat = t.select("transaction_id", "timestamp", F.col("amount").alias("total_ticket"),
                    id_items(t, "product_ids").alias("_item")) \
        .withColumn("product_sku", F.col("_item").try_cast("bigint")).drop("_item")
    p = products_silver
    cols = ["transaction_id", "timestamp", "total_ticket", "product_sku",
            p.name.alias("product_name"), p.price.alias("product_price")]
    if with_tax:
        cols.append(calculate_tax(p.price).alias("producto_price_tax_inc"))
    cols.append(p.category)
    return flat.join(p, flat.product_sku == p.product_id).select(*cols)


def top_products(flat: DataFrame, k: int = 5) -> DataFrame:
    """PIP21: most sold products of the flat fact (top-k, ties by name)."""
    return flat.groupBy("product_name").agg(F.count("product_sku").alias("total_vendido")) \
        .orderBy(F.desc("total_vendido"), "product_name").limit(k)


def company_transactions_at(companies_silver: DataFrame, transactions_silver: DataFrame,
                            country: str, ts: str, day: bool = False) -> DataFrame:
    """FLT7/PRJ1: ``c.company_name, t.*`` of a country where the timestamp
    *equals* a date literal, i.e. exactly midnight of that day (as the
    reference's comparison does).  ``day=True`` matches the whole day
    instead, as a half-open timestamp range that still reaches the scan."""
    c = companies_silver.filter(F.col("country") == country)
    start = F.lit(ts).cast("timestamp_ntz")
    if day:
        start = F.to_date(start).cast("timestamp_ntz")
        t = transactions_silver.filter((F.col("timestamp") >= start)
                                       & (F.col("timestamp") < start + F.expr("INTERVAL 1 DAY")))
    else:
        t = transactions_silver.filter(F.col("timestamp") == start)
    return c.join(t, c.company_id.cast("string") == t.business_id).select(c.company_name, t["*"])
