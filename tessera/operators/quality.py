"""Data-quality checks (DQ1-DQ4) and key-conflict resolution (CLN5).

Constraints the reference declared in DDL are re-aimed as queries that
return the offending rows/counts; nothing is enforced at write time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ1: key values that repeat, plus rows with a NULL key part.

    Output ``(kind, n_keys, n_rows)``; one partial aggregate on the key.
    """
    k = list(keys)
    null_any = F.greatest(*[F.col(c).isNull() for c in k]) if len(k) > 1 else F.col(k[0]).isNull()
    g = df.groupBy(*k).agg(F.count("*").alias("n"), F.max(null_any).alias("_null"))
    return g.agg(
        F.count_if((F.col("n") > 1) & ~F.col("_null")).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when((F.col("n") > 1) & ~F.col("_null"), F.col("n"))), F.lit(0))
        .cast("bigint").alias("rows_in_duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("n"))), F.lit(0)).cast("bigint")
        .alias("rows_with_null_key"))


def not_null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ2: NULL count per NOT NULL column, ``(column, nulls)``."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], list(cols), "column", "nulls")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """DQ3: child rows whose non-NULL foreign key has no parent (left anti)."""
    p = parent.select(F.col(pk).alias("_pk"))
    return child.filter(F.col(fk).isNotNull()).join(p, F.col(fk) == F.col("_pk"), "left_anti")


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """DQ4: declared column defaults applied at ingest (``coalesce``)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def resolve_key_conflicts(df: DataFrame, key: str, identity: Sequence[str], ord_col: str
                          ) -> tuple[DataFrame, DataFrame]:
    """CLN5: same key, different person → drop the whole key group; same
    person resubmitted → keep the first row.

    Conflicts are *derived* (groups whose identity columns take more than one
    value) instead of listed by hand.  Returns ``(kept, dropped)``;
    ``dropped`` carries a ``reason``.  No group is materialised in one task.
    NULL keys are kept apart (never merged with each other); ``ord_col`` is
    unique.
    """
    ident = F.struct(*[F.col(c) for c in identity])
    # A key conflicts when its rows do not all carry the same identity, i.e.
    # the smallest and largest differ: one partial aggregate (a hot key
    # collapses map-side) and one join, which both results are filters of.
    g = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
        F.min(ident).alias("_lo"), F.max(ident).alias("_hi"), F.min(ord_col).alias("_first"))
    told = g.select("_k", "_first", (~F.col("_lo").eqNullSafe(F.col("_hi"))).alias("_bad"))
    reason = (F.when(F.col("_bad"), F.lit("conflicting_identity"))
              .when(F.col(ord_col) > F.col("_first"), F.lit("resubmitted_duplicate")))
    marked = df.join(told, F.col(key) == F.col("_k"), "left").withColumn("reason", reason).drop("_k", "_first", "_bad")
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())
