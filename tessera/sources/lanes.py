"""Trade lanes between nations, derived from the order lines (PIP12 input).

An edge exists from a customer's nation to a supplier's nation when some
order line connects them; its distance is a fixed function of both keys
(there is no geography in the driver tables).  Built with equi-joins only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage
from tessera.sources.tables import Tables

ISLANDS = ("NATION_23", "NATION_24")  # excluded from routing, like the island cities


def lane_keys(t: Tables) -> DataFrame:
    li, o, c, s = t.lineitem, t.orders, t.customer, t.supplier
    x = li.select("l_orderkey", "l_suppkey") \
        .join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")) \
        .join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")) \
        .join(s.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return cut_lineage(x.select(F.col("c_nationkey").alias("a"), F.col("s_nationkey").alias("b")).distinct(), "lanes")


def lane_edges(t: Tables, lanes: DataFrame | None = None) -> DataFrame:
    """``(src, dst, km, ord)`` by nation name; ``ord`` = destination key."""
    k = lane_keys(t) if lanes is None else lanes
    n = t.nation
    na = n.select(F.col("n_nationkey").alias("_a"), F.col("n_name").alias("src"))
    nb = n.select(F.col("n_nationkey").alias("_b"), F.col("n_name").alias("dst"))
    km = F.when(F.col("a") == F.col("b"), F.lit(0.0)).otherwise(
        (F.lit(50) + F.pmod((F.least("a", "b") + 1) * (F.greatest("a", "b") + 1) * 37
                            + (F.col("a") + F.col("b")) * 11, F.lit(997))).cast("double"))
    return k.join(na, k.a == na._a).join(nb, k.b == nb._b).select(
        "src", "dst", km.alias("km"), F.col("b").cast("int").alias("ord")) \
        .filter(~F.col("src").isin(list(ISLANDS)) & ~F.col("dst").isin(list(ISLANDS)))


def route_requests(t: Tables, lanes: DataFrame | None = None) -> DataFrame:
    """One request per lane (islands included: they come back as errors)."""
    k = lane_keys(t) if lanes is None else lanes
    n = t.nation
    na = n.select(F.col("n_nationkey").alias("_a"), F.col("n_name").alias("origin"))
    nb = n.select(F.col("n_nationkey").alias("_b"), F.col("n_name").alias("destination"))
    return k.join(na, k.a == na._a).join(nb, k.b == nb._b).select(
        (F.col("a") * 1000 + F.col("b")).alias("req_id"), "origin", "destination")
