"""Delimited text with rejects, and row numbers over many or split files (SRC1-SRC3, SRC5-SRC9, CLN1).

A line that does not fit its schema (a field that cannot be read, too few or too
many fields) is kept as text with the file and the offset of the block it came from.  The input is parsed
once: rows and rejects are two filters of one written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.scans import running_sum
from tessera.session import cut_lineage
from tessera.sources.files import read_delimited

_LINE, _FILE, _BLOCK = "_line", "_file", "_block"


def read_with_rejects(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, **options) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of delimited files; ``options`` as in ``read_delimited``.

    ``rejects`` is (_file, _block, _line): the file's name, the offset of the
    split that the line was read in, and the line itself.
    """
    wide = T.StructType([*schema.fields, T.StructField(_LINE, T.StringType())])
    read = read_delimited(spark, paths, schema=wide, corrupt_column=_LINE, **options)
    parsed = cut_lineage(read.select("*", F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK)),
                         "parsed")
    names = [f.name for f in schema.fields]
    return (parsed.where(F.col(_LINE).isNull()).select(*names),
            parsed.where(F.col(_LINE).isNotNull()).select(_FILE, _BLOCK, _LINE))


def read_with_ordinal(spark: SparkSession, paths: str | Sequence[str], n_columns: int, ord_col: str = "_ord", **options) -> DataFrame:
    """SRC8/CLN1: headerless text columns ``_c0..`` and the row's 0-based place over all files in path order.

    First pass: rows are written with their file, the offset of their split and an
    id that counts inside the split.  Second pass: one count per split, whose
    running sums are the splits' bases.  The rows themselves are not shuffled,
    and a file may be split over any number of tasks.
    """
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(n_columns)])
    read = read_delimited(spark, paths, schema=schema, header=False, **options)
    rows = cut_lineage(read.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK),
                                   F.monotonically_increasing_id().alias("_id")), "numbered")
    splits = rows.groupBy(_FILE, _BLOCK).agg(F.min("_id").alias("_least"), F.count("*").alias("_n"))
    upto = running_sum(splits, [_FILE, _BLOCK], "_n", "_upto")
    bases = upto.select(F.col(_FILE).alias("_f"), F.col(_BLOCK).alias("_b"), "_least", (F.col("_upto") - F.col("_n")).alias("_base"))
    return rows.join(bases, (F.col(_FILE) == F.col("_f")) & (F.col(_BLOCK) == F.col("_b"))).select(
        *schema.fieldNames(), (F.col("_base") + F.col("_id") - F.col("_least")).alias(ord_col))
