"""Numeric functions (MTH1-MTH10, UDF1)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def safe_divide(a: Column, b: Column) -> Column:
    """MTH3: ``SAFE_DIVIDE`` — NULL on a zero divisor."""
    return F.try_divide(a, F.nullif(b, F.lit(0)))


def pct_change(cur: Column, prev: Column, scale: int = 2) -> Column:
    """MTH4: ``ROUND(SAFE_DIVIDE(cur - prev, prev) * 100, 2)``."""
    return F.round(safe_divide(cur - prev, prev) * 100, scale)


def clip_upper(c: Column, hi) -> Column:
    """MTH5: pandas ``clip(upper=)`` keeps NULL (``least`` would skip it)."""
    return F.when(c.isNotNull(), F.least(c, F.lit(hi) if not isinstance(hi, Column) else hi))


def clip_lower(c: Column, lo) -> Column:
    """MTH5: pandas ``clip(lower=)`` keeps NULL (``greatest`` would skip it)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(lo) if not isinstance(lo, Column) else lo))


def key_day_offset(key: Column, span: int = 50) -> Column:
    """MTH9 re-aimed: a repeatable day offset in ``[0, span]`` from the key
    instead of ``CAST(RAND()*50 AS INT64)``."""
    return F.pmod(key.cast("bigint"), F.lit(span + 1)).cast("int")


TAX_RATE = 1.21  # fixed value: VAT multiplier of ``calculate_tax``


def calculate_tax(amount: Column) -> Column:
    """UDF1 as a Column function; Catalyst inlines it like the SQL version."""
    return amount * F.lit(TAX_RATE)


def register_sql_functions(spark: SparkSession) -> None:
    """UDF1 as a SQL temporary function (``CREATE TEMPORARY FUNCTION``)."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION calculate_tax(amount DOUBLE) "
              f"RETURNS DOUBLE RETURN amount * {TAX_RATE}")


def round_money(c: Column, digits: int = 2) -> Column:
    """Round a double money value half-up *on its decimal value*.

    The value is first fixed to 6 decimals (this absorbs the last-bit noise
    that summation order leaves in a double), then rounded to ``digits``; an
    exact tie such as ``x.xx5`` therefore rounds the same way on every run
    and every partitioning.
    """
    return F.round(c.cast("decimal(20,6)"), digits).cast("double")
