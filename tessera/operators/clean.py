"""Small cleaning/filter helpers (CLN3, FLT4, FLT8, FLT10, SRT6, AGG16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_unrecoverable(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """CLN3/FLT12: drop rows where every required field is NULL
    (``dropna(how='all', subset=required)``) — a rule instead of positions."""
    return df.dropna(how="all", subset=list(required))


def not_in_keep_null(c: Column, values: Sequence) -> Column:
    """FLT4: pandas ``~isin(values)`` keeps NULL rows; SQL ``NOT IN`` drops them."""
    return c.isNull() | ~c.isin(list(values))


def contains_ci(c: Column, needle: str) -> Column:
    """FLT8: case-insensitive contains, NULL → False."""
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def mask_and_null(a: Column, value, b: Column) -> Column:
    """FLT10: ``(a == value) & b.isnull()`` as a NULL-safe boolean."""
    return F.coalesce(a == F.lit(value), F.lit(False)) & b.isNull()


def duplicated_rows(df: DataFrame, key: str) -> DataFrame:
    """SRT6/AGG17: every row whose key repeats (``duplicated(keep=False)``),
    sorted by the key for inspection.  Counts per key are a partial
    aggregate joined back, so a hot key is not buffered in one window."""
    dup = df.groupBy(F.col(key).alias("_k")).count().filter("count > 1").select("_k")
    return df.join(dup, F.col(key).eqNullSafe(F.col("_k")), "left_semi").orderBy(key)


def distinct_values(df: DataFrame, c: str, dropna: bool = True) -> DataFrame:
    """AGG16: distinct values (``dropna().unique()``)."""
    d = df.select(c)
    return (d.dropna() if dropna else d).distinct()
