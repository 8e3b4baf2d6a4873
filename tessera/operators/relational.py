"""Joins, aggregates, sorts and set operations that need more than one
built-in call (JN13-JN16, AGG11-AGG26, SRT5, SET2, SET3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.order_stats import exact_medians


class LookupMissError(ValueError):
    """Raised by ``check_no_misses`` when keys are unmapped."""


def lookup(df: DataFrame, dim: DataFrame, left_key: str | Column, dim_key: str,
           on_miss: str = "null", keep_col: str | None = None) -> DataFrame:
    """JN13/JN14/JN15: one lookup operator, three miss policies.

    * ``'null'``  — ``Series.map``: unmapped → NULL columns (left join).
    * ``'keep'``  — ``Series.replace``: unmapped keeps ``keep_col``'s value;
      the dimension's single value column replaces ``keep_col`` otherwise.
    * ``'error'`` — dict ``[]``: the job fails on the first row whose key is
      unmapped (also a NULL one); no row is dropped.

    No broadcast is forced: Spark chooses from the dimension's size in bytes.
    """
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    renamed = dim.withColumnRenamed(dim_key, "_lk")
    out = df.join(renamed, lk == renamed._lk, "left")
    if on_miss == "error":
        # checked in the same job, on a value that the caller reads
        missing = F.raise_error(F.concat(F.lit("unmapped key: "), F.coalesce(lk.cast("string"), F.lit("NULL"))))
        for c in dim.columns:
            if c != dim_key:
                out = out.withColumn(c, F.when(F.col("_lk").isNull(), missing).otherwise(F.col(c)))
    out = out.drop("_lk")
    if on_miss == "keep":
        if keep_col is None:
            raise ValueError("on_miss='keep' needs keep_col")
        vcols = [c for c in dim.columns if c != dim_key]
        if len(vcols) != 1:
            raise ValueError("on_miss='keep' needs a one-value dimension")
        out = out.withColumn(keep_col, F.coalesce(F.col(vcols[0]), F.col(keep_col))).drop(vcols[0])
    return out


def find_misses(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str) -> DataFrame:
    """Rows whose key has no entry in the dimension (the would-be KeyErrors)."""
    return df.join(dim.select(F.col(dim_key).alias("_lk")), F.col(left_key) == F.col("_lk"), "left_anti")


def check_no_misses(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str) -> None:
    """JN13 strict mode: raise when any key is unmapped (one cheap job)."""
    miss = find_misses(df, dim, left_key, dim_key).select(left_key).limit(5).collect()  # five for the message
    if miss:
        raise LookupMissError(f"unmapped {left_key}: {[r[0] for r in miss]}")


def transform_agg(df: DataFrame, group: str, col: str, fn: str = "median",
                  out: str | None = None, null_group_is_null: bool = True) -> DataFrame:
    """JN16/WIN6: ``groupby(g)[c].transform(fn)`` as aggregate + join back.

    The aggregate is one row per group (partial aggregation before the
    shuffle), then joined back on the key, so a hot group is never held in
    one window buffer.  pandas gives NULL-key rows NULL; Spark would treat
    NULL as a group, so those rows are guarded.
    """
    out = out or f"{fn}_{col}"
    if fn == "median":
        g = exact_medians(df.select(F.col(group).alias("_g"), F.col(col)), ["_g"], {out: col})
    else:
        agg = {"mean": F.avg, "avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}[fn]
        g = df.groupBy(F.col(group).alias("_g")).agg(agg(col).alias(out))
    if null_group_is_null:
        g = g.filter(F.col("_g").isNotNull())
    # plain equality lets Catalyst drop the join where the statistic is not read
    same = F.col(group) == F.col("_g") if null_group_is_null else F.col(group).eqNullSafe(F.col("_g"))
    return df.join(g, same, "left").drop("_g")


def fill_from_group_then_global(df: DataFrame, group: str, col: str, fn: str = "median") -> DataFrame:
    """CLN8/CLN9: fill NULL with the group statistic, then (for the median
    variant) with the global statistic computed *after* the group fill."""
    tmp = "_grp_stat"
    filled = transform_agg(df, group, col, fn, out=tmp) \
        .withColumn(col, F.coalesce(F.col(col), F.col(tmp))).drop(tmp)
    glob = (exact_medians(filled, [], {col: col}) if fn == "median" else filled.select(F.avg(col))).scalar()
    return filled.withColumn(col, F.coalesce(F.col(col), glob))


def keep_first(df: DataFrame, keys: Sequence[str], ord_col: str) -> DataFrame:
    """SET2: ``drop_duplicates(subset=keys, keep='first')`` with an ordinal.

    ``row_number() = 1`` is planned as a WindowGroupLimit, so each map task
    keeps one row per key before the shuffle (a hot key costs one row).
    """
    w = Window.partitionBy(*keys).orderBy(ord_col)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def arg_max(df: DataFrame, score: str, ord_col: str, lowest: bool = False) -> DataFrame:
    """AGG21: the single row with the max (or min) score, first on ties."""
    s = F.col(score).asc() if lowest else F.col(score).desc()
    return df.orderBy(s, F.col(ord_col).asc()).limit(1)


def groups_with_several(df: DataFrame, group: str, min_members: int = 2) -> DataFrame:
    """AGG23: members of groups that have at least ``min_members`` rows.

    Counts per group (partial aggregate) joined back — not a window, so a hot
    group is counted across tasks."""
    n = df.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("group_size")) \
        .filter(F.col("group_size") >= min_members)
    return df.join(n, F.col(group) == F.col("_g")).drop("_g")


def value_counts(df: DataFrame, col: str, top: int | None = None, as_text: bool = False) -> DataFrame:
    """AGG14: counts incl. NULL, most frequent first (``head(n)`` when asked).

    ``as_text`` mimics ``astype(str).value_counts()``: NULL becomes ``'nan'``.
    """
    c = F.coalesce(F.col(col).cast("string"), F.lit("nan")) if as_text else F.col(col)
    out = df.groupBy(c.alias("value")).agg(F.count("*").alias("freq")) \
        .orderBy(F.desc("freq"), F.asc_nulls_first("value"))
    return out.limit(top) if top else out


def group_stats(df: DataFrame, group: str, col: str, digits: int = 2,
                dropna_keys: bool = True) -> DataFrame:
    """AGG11: mean/median/min/max per group, rounded, sorted by mean desc.

    ``median`` is exact (interpolated, as pandas) and holds no group's values
    together; null keys dropped as in ``groupby``.
    """
    from tessera.functions.numeric import round_money
    d = df.filter(F.col(group).isNotNull()) if dropna_keys else df
    medians = exact_medians(d, [group], {"_median": col}).withColumnRenamed(group, "_g")
    return d.groupBy(group).agg(
        round_money(F.avg(col), digits).alias("sou_mig"),
        round_money(F.min(col), digits).alias("minim"),
        round_money(F.max(col), digits).alias("maxim")).join(medians, F.col(group).eqNullSafe(F.col("_g"))).select(
        group, "sou_mig", round_money(F.col("_median"), digits).alias("mediana"), "minim", "maxim").orderBy(F.desc("sou_mig"))


def share_of_rows(df: DataFrame, group: str) -> DataFrame:
    """AGG24: share of rows per group (count / total)."""
    g = df.groupBy(group).agg(F.count("*").alias("n"))
    # the total is summed over the group table: the rows are read once
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))


def group_gap(df: DataFrame, by: str, split_col: str, a: str, b: str, value: str,
              digits: int = 2) -> DataFrame:
    """AGG25: per ``by``: mean(value | split=a) − mean(value | split=b) and
    the ratio; means and gap rounded to ``digits`` (a money report), the
    ratio to 4."""
    from tessera.functions.numeric import round_money
    g = df.groupBy(by).agg(F.avg(F.when(F.col(split_col) == a, F.col(value))).alias("_a"),
                           F.avg(F.when(F.col(split_col) == b, F.col(value))).alias("_b"))
    return g.select(by, round_money(F.col("_a"), digits).alias("mean_a"),
                    round_money(F.col("_b"), digits).alias("mean_b"),
                    round_money(F.col("_a") - F.col("_b"), digits).alias("gap"),
                    round_money(F.try_divide(F.col("_a"), F.col("_b")), 4).alias("ratio"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """AGG26: fixed-width buckets between min and max, counts per bucket.

    Min/max come from one global aggregate (scalar subquery); the bucket is
    computed per row and counted with a partial aggregate.
    """
    b = df.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()  # one job
    lo, hi = b.getField("lo"), b.getField("hi")
    width = (hi - lo) / F.lit(bins)
    idx = F.least(F.floor(F.try_divide(F.col(col) - lo, width)), F.lit(bins - 1))
    b = F.when(F.col(col).isNotNull(), F.coalesce(idx, F.lit(0)).cast("int"))
    return df.where(F.col(col).isNotNull()).groupBy(b.alias("bucket")).agg(
        F.count("*").alias("freq"), F.min(col).alias("lo_value"), F.max(col).alias("hi_value"))


def stable_rank_desc(df: DataFrame, score: str, ord_col: str) -> DataFrame:
    """SRT5: Python's stable ``sorted(key=score, reverse=True)``."""
    return df.orderBy(F.desc(score), F.asc(ord_col))


def dedupe_column_names(df: DataFrame) -> DataFrame:
    """SET3/CLN2: strip column names, keep the first of duplicated names."""
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])  # names that repeat cannot be asked for
    first: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        first.setdefault(name.strip(), i)
    return plain.select(*[F.col(f"_{i}").alias(name) for name, i in first.items()])
