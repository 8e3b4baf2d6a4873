"""File sources (SRC1-SRC7, SRC9, SRC10, SRC13).

All readers are plain ``DataFrameReader`` calls with an explicit schema where
the reference declares one, so no inference pass is made over large inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.dates import mysql_short_date


def all_string_schema(names: Sequence[str]) -> T.StructType:
    """SRC6: every column STRING ("schema on read"), cast later in silver."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def read_delimited(spark: SparkSession, paths: str | Sequence[str], *,
                   schema: T.StructType | str | None = None, sep: str = ",",
                   header: bool = True, quote: str | None = '"',
                   line_sep: str | None = None, encoding: str | None = None,
                   infer_schema: bool = False, corrupt_column: str | None = None) -> DataFrame:
    """SRC1/SRC2/SRC3/SRC5/SRC6/SRC7/SRC9: delimited text.

    ``paths`` may list several files (SRC7, appended into one frame).
    ``header=True`` skips the first line (``IGNORE 1 LINES``); with a
    ``schema`` the columns are positional, as in ``LOAD DATA``.
    ``encoding`` covers legacy code pages such as ISO-8859-1 (SRC9).
    ``infer_schema`` (SRC5) costs an extra pass; prefer a schema at scale.
    ``corrupt_column`` of the schema takes the text of lines that do not fit.
    """
    r = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if corrupt_column is not None:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    if quote is not None:
        r = r.option("quote", quote)
    if line_sep is not None:
        r = r.option("lineSep", line_sep)
    if encoding is not None:
        r = r.option("encoding", encoding)
    if schema is not None:
        r = r.schema(schema)
    elif infer_schema:
        r = r.option("inferSchema", True)
    return r.csv(list(paths) if not isinstance(paths, str) else paths)


def read_with_transform(spark: SparkSession, path: str, schema: T.StructType,
                        transforms: dict[str, Column], **kw) -> DataFrame:
    """SRC4: load, then per-column transform (``SET col = f(@var)``)."""
    df = read_delimited(spark, path, schema=schema, **kw)
    return df.withColumns(transforms)


def read_cards_csv(spark: SparkSession, path: str, **kw) -> DataFrame:
    """SRC4 example: card file whose expiry is text ``MM/dd/yy``."""
    cols = ["id", "user_id", "iban", "pan", "pin", "cvv", "track1", "track2",
            "expiring_date"]
    return read_with_transform(
        spark, path, all_string_schema(cols),
        {"expiring_date": mysql_short_date(F.col("expiring_date")),
         "user_id": F.col("user_id").try_cast("int")}, **kw)


def read_policy(spark: SparkSession, path: str) -> DataFrame:
    """SRC10: nested JSON rules document → one row ``policy`` VARIANT (MAP1: ``try_variant_get``)."""
    return spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("policy"))


def read_distance_matrix(spark: SparkSession, path: str, key_col: str | None = None,
                         sep: str = ",") -> DataFrame:
    """SRC13: labelled square matrix, first column the row label."""
    df = spark.read.option("header", True).option("sep", sep).option("inferSchema", True).csv(path)
    key = key_col or df.columns[0]
    return df.withColumnRenamed(key, "city") if key != "city" else df
