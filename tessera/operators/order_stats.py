"""Exact quantiles by refining histograms (AGG11, AGG13, AGG19, CLN8).

A value becomes a 64-bit key that sorts as the value does.  A pass counts the
keys of each group by their next ``BITS`` bits, which is one partial aggregate,
and the running count over a group's buckets names the bucket in which a wanted
rank lies; the next pass looks into those buckets only.  So a group's values are
never held together: what one task holds is at most ``2^BITS`` counts, and, once the
buckets in question hold no more than ``limit`` rows each, those rows.  There are
at most 64 / ``BITS`` passes, whatever the distribution.

Groups whose rows are few from the start need no pass: Spark's exact
percentile keeps at most ``limit`` values of each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

BITS, KEY_BITS, LIMIT = 16, 64, 200_000


def sort_key(x: Column) -> Column:
    """A bigint that orders as the double does; -0.0 as 0.0, infinities outermost, NaN greatest.

    Made from the exact hexadecimal form: exponent, then the 52 bits of the fraction.
    """
    form = F.format_string("%a", F.abs(x))
    exponent = F.substring_index(form, "p", -1).cast("bigint")
    digits = F.substring_index(F.substring_index(form, "p", 1), ".", -1)
    fraction = F.conv(F.rpad(digits, 13, "0"), 16, 10).cast("bigint")
    normal = F.when(form.startswith("0x1."), exponent + 1023).otherwise(0)  # else zero or denormal
    bits = F.shiftleft(normal, 52).bitwiseOR(fraction)
    infinite = F.lit(2047 << 52).cast("bigint")
    size = F.when(F.isnan(x), infinite + 1).when(F.abs(x) == float("inf"), infinite).otherwise(bits)
    return F.when((x < 0) & ~F.isnan(x), -size).otherwise(size)


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _long(df: DataFrame, by: Sequence[str], values: Mapping[str, Column | str]) -> DataFrame:
    """(by..., which, x) of all values that are not NULL."""
    columns = [F.col(v) if isinstance(v, str) else v for v in values.values()]
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("which"), c.cast("double").alias("x")) for i, c in enumerate(columns)]))
    return df.select(*[F.col(b) for b in by], each.alias("__v")).select(*by, "__v.which", "__v.x").where("x is not null")


def _position(n: Column, p: Column) -> Column:
    return p * (n - 1)


def _interpolated(low: Column, high: Column, position: Column) -> Column:
    """The value at a place between two ranks, in the form that Spark's percentile uses."""
    floor = F.floor(position).cast("double")
    return F.when(low == high, low).otherwise((floor + 1 - position) * low + (position - floor) * high)


def ranked_values(long: DataFrame, wanted: DataFrame, by: Sequence[str], limit: int = LIMIT, bits: int = BITS) -> DataFrame:
    """(by..., which, rank, x) for the 0-based ranks in ``wanted`` (by..., which, rank, n rows of the group)."""
    keys = cut_lineage(long.withColumn("key", sort_key(F.col("x"))), "order-keys")
    group = [*by, "which"]
    state = wanted.select(*group, "rank", F.col("rank").alias("left"), F.lit(0).cast("bigint").alias("prefix"), F.col("n").alias("inside"))
    shift = KEY_BITS
    while shift > 0:
        state = cut_lineage(state, "order-state")
        if state.where(F.col("inside") > limit).isEmpty():
            break
        above, shift = shift, shift - bits
        # The bucket of the first pass is signed, so negative values come first.
        bucket = F.shiftright("key", shift)
        inside = _inside(keys, state, group, above)
        hist = inside.groupBy(*group, "prefix", bucket.alias("bucket")).agg(F.count("*").alias("rows"))
        order = Window.partitionBy(*group, "prefix").orderBy("bucket")  # at most 2^bits counts
        upto = hist.withColumn("upto", F.sum("rows").over(order))
        renamed = upto.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("prefix").alias("_prefix"), "bucket", "rows", "upto")
        found = state.join(renamed, _same([*group, "prefix"], [f"_{g}" for g in [*group, "prefix"]])
                           & (F.col("left") < F.col("upto")) & (F.col("left") >= F.col("upto") - F.col("rows")))
        state = found.select(*group, "rank", (F.col("left") - F.col("upto") + F.col("rows")).alias("left"),
                             F.col("bucket").alias("prefix"), F.col("rows").alias("inside"))
    rest = _inside(keys, state, group, shift)
    if shift == 0:  # a bucket is one value, however many rows it has
        one = rest.groupBy(*group, "prefix").agg(F.min("x").alias("x"))
        return _with_rank(state, one, group, F.lit(True))
    order = Window.partitionBy(*group, "prefix").orderBy("key")  # at most ``limit`` rows
    placed = rest.select(*group, "prefix", "x", (F.row_number().over(order) - 1).alias("at"))
    return _with_rank(state, placed, group, F.col("left") == F.col("at"))


def _inside(keys: DataFrame, state: DataFrame, group: Sequence[str], shift: int) -> DataFrame:
    """The keys that lie in a bucket of ``state``, with its prefix."""
    buckets = state.select(*[F.col(g).alias(f"_{g}") for g in group], "prefix").distinct()
    own = F.lit(0).cast("bigint") if shift >= KEY_BITS else F.shiftright("key", shift)
    return keys.withColumn("_own", own).join(
        buckets, _same([*group, "_own"], [*[f"_{g}" for g in group], "prefix"])).select(*keys.columns, "prefix")


def _with_rank(state: DataFrame, values: DataFrame, group: Sequence[str], more: Column) -> DataFrame:
    right = values.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("prefix").alias("_prefix"),
                          *[c for c in values.columns if c not in (*group, "prefix")])
    return state.join(right, _same([*group, "prefix"], [f"_{g}" for g in [*group, "prefix"]]) & more).select(*group, "rank", "x")


def exact_quantiles(df: DataFrame, by: Sequence[str], values: Mapping[str, Column | str], probabilities: Sequence[float],
                    limit: int = LIMIT, bits: int = BITS) -> DataFrame:
    """``by...`` and, per entry of ``values``, an array of its interpolated quantiles (NULL without values).

    NULL group keys are a group.  Without ``by`` there is one row.
    """
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    long = _long(df, by, values)
    group = [*by, "which"]
    sizes = cut_lineage(long.groupBy(*group).agg(F.count("*").alias("n")), "order-sizes")
    most = sizes.agg(F.max("n")).first()[0] or 0
    ps = [float(p) for p in probabilities]
    if most <= limit:  # a group's percentile holds at most ``limit`` values
        found = long.groupBy(*group).agg(F.percentile("x", F.array(*[F.lit(p) for p in ps])).alias("q"))
    else:
        asked = sizes.withColumn("p", F.explode(F.array(*[F.lit(p) for p in ps]))).withColumn("at", _position(F.col("n"), F.col("p")))
        ends = asked.withColumn("rank", F.explode(F.array(F.floor("at"), F.ceil("at")))).select(*group, "rank", "n").distinct()
        got = cut_lineage(ranked_values(long, ends, by, limit, bits), "order-values")
        sides = [got.select(*[F.col(g).alias(f"_{s}_{g}") for g in group], F.col("rank").alias(f"_{s}_rank"), F.col("x").alias(s))
                 for s in ("low", "high")]
        both = asked
        for side, place in zip(("low", "high"), (F.floor("at"), F.ceil("at"))):
            both = both.withColumn("__r", place).join(sides[side == "high"], _same([*group, "__r"], [f"_{side}_{g}" for g in (*group, "rank")]))
        value = F.struct("p", _interpolated(F.col("low"), F.col("high"), F.col("at")).alias("v"))
        found = both.groupBy(*group).agg(F.collect_list(value).alias("pairs")).select(
            *group, F.transform(F.array(*[F.lit(p) for p in ps]),
                                lambda p: F.get(F.filter("pairs", lambda s: s["p"] == p), F.lit(0))["v"]).alias("q"))
    wide = found.groupBy(*by).agg(*[F.max(F.when(F.col("which") == i, F.col("q"))).alias(name) for i, name in enumerate(values)])
    if not by:
        return wide
    renamed = wide.select(*[F.col(b).alias(f"__{b}") for b in by], *values)
    return groups.join(renamed, _same(by, [f"__{b}" for b in by]), "left").select(*by, *values)


def exact_medians(df: DataFrame, by: Sequence[str], values: Mapping[str, Column | str], limit: int = LIMIT, bits: int = BITS) -> DataFrame:
    """``by...`` and the interpolated median of every entry of ``values``."""
    found = exact_quantiles(df, by, values, [0.5], limit, bits)
    return found.select(*by, *[F.get(F.col(v), F.lit(0)).alias(v) for v in values])
