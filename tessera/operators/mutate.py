"""Table mutations as DataFrame rewrites (MUT1-MUT7).

Spark tables are immutable files; an UPDATE/DELETE is a new version of the
table written by the caller (``sinks.replace_table``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_rows(df: DataFrame, new: DataFrame) -> DataFrame:
    """MUT1: append rows; unspecified columns become NULL."""
    return df.unionByName(new, allowMissingColumns=True).select(*df.columns)


def update_by_key(df: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """MUT2: ``UPDATE … SET c = v WHERE key = k`` for a table of changes.

    A left join on the key; a changed column takes the new value where the
    change row exists (even when the new value is NULL), the old one
    otherwise.  Change keys must be unique (they are, in an UPDATE by key)."""
    cols = [c for c in changes.columns if c != key]
    ch = changes.select(F.col(key).alias("_ck"), F.lit(True).alias("_hit"),
                        *[F.col(c).alias(f"_new_{c}") for c in cols])
    j = df.join(ch, F.col(key) == F.col("_ck"), "left")
    return j.select(*[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
                      if c in cols else F.col(c) for c in df.columns])


def set_column_case(df: DataFrame, col: str, expr: Column) -> DataFrame:
    """MUT3: ``UPDATE t SET col = CASE … END`` over every row."""
    return df.withColumn(col, expr)


def continent_of(country: Column) -> Column:
    """MUT3 example: United States / Canada → America, anything else (NULL
    included) → Europe."""
    return F.when(country.isin("United States", "Canada"), F.lit("America")).otherwise(F.lit("Europe"))


def delete_by_key(df: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """MUT4: ``DELETE … WHERE key IN (…)`` → left anti join."""
    return df.join(deleted.select(F.col(key).alias("_dk")), F.col(key) == F.col("_dk"), "left_anti")


def add_column(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """MUT5: ``ALTER TABLE ADD COLUMN`` (NULL-filled)."""
    return df.withColumn(name, F.lit(None).cast(dtype))


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """MUT6: drop, ignoring missing names (``errors='ignore'``)."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """MUT7: rename by map (missing names ignored)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
