"""Reshape operators (RSH1-RSH4, AGG15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import round_money


def melt(df: DataFrame, metrics: Sequence[str], var_name: str = "metrica",
         value_name: str = "valor") -> DataFrame:
    """RSH1: ``melt`` with ids = every column not in ``metrics``.

    Metrics are cast to double first (one value type); ``DataFrame.unpivot``
    keeps NULL values, as ``melt`` does.  Narrow: no shuffle.
    """
    present = [m for m in metrics if m in df.columns]
    ids = [c for c in df.columns if c not in present]
    typed = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in present])
    return typed.unpivot(ids, present, var_name, value_name)


def pivot_mean(df: DataFrame, row: str, col: str, value: str, col_values: Sequence | None = None,
               digits: int = 2) -> DataFrame:
    """RSH2: ``pivot_table(aggfunc='mean')`` with an explicit value list (no
    extra distinct job when the caller knows the values)."""
    g = df.groupBy(row)
    g = g.pivot(col, list(col_values)) if col_values is not None else g.pivot(col)
    out = g.agg(F.avg(value))
    return out.select(row, *[F.round(F.col(f"`{c}`"), digits).alias(str(c))
                             for c in out.columns if c != row])


def pivot_with_margins(df: DataFrame, row: str, col: str, value: str,
                       margin: str = "Mitjana_total", digits: int = 2) -> DataFrame:
    """AGG15: means by (row, col) plus row, column and grand margins, in the
    long form ``(row, col, mean)``; margins average the *rows*, not cell means.

    One ``cube`` aggregation computes every cell and margin in a single
    shuffle; rows with a NULL key are excluded first, as pandas does.  The
    wide form is ``pivot`` of this on ``col`` with the caller's value list.
    """
    d = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
    c = d.cube(row, col).agg(F.avg(value).alias("_m"), F.grouping_id().alias("_gid"))
    return c.select(
        F.when(F.col("_gid").bitwiseAND(2) == 2, F.lit(margin)).otherwise(F.col(row)).alias(row),
        F.when(F.col("_gid").bitwiseAND(1) == 1, F.lit(margin)).otherwise(F.col(col)).alias(col),
        round_money(F.col("_m"), digits).alias("mean"))


def matrix_to_edges(matrix: DataFrame, key: str = "city", exclude: Sequence[str] = ()) -> DataFrame:
    """RSH4/SRC13: square distance matrix → ``(src, dst, km, ord)`` edges.

    ``ord`` is the destination's column position (first column wins ties, as
    ``idxmin``).  Excluded cities are removed on both axes; missing ones are
    ignored.  Diagonal and NULL distances are kept as data; routing skips
    them.
    """
    dst_cols = [c for c in matrix.columns if c != key and c not in exclude]
    stacked = matrix.filter(~F.col(key).isin(list(exclude)) if exclude else F.lit(True)) \
        .select(F.col(key).alias("src"),
                F.explode(F.array(*[F.struct(F.lit(c).alias("dst"), F.col(f"`{c}`").cast("double").alias("km"),
                                             F.lit(i).alias("ord"))
                                    for i, c in enumerate(dst_cols)])).alias("e"))
    return stacked.select("src", "e.dst", "e.km", "e.ord")


def margins_wide(long: DataFrame, row: str, col: str, col_values, margin: str = "Mitjana_total") -> DataFrame:
    """AGG15 wide form: one row per ``row`` value (plus the margin row), one
    column per ``col`` value in the caller's order plus the margin column —
    ``pivot`` with an explicit value list, so no extra distinct job."""
    values = list(col_values) + [margin]
    return long.groupBy(row).pivot(col, values).agg(F.first("mean"))
