"""Places in a global order without a global window (SRT1, SRT2, SRT5; PIP22, PIP24, PIP25).

Rows are range-partitioned, sorted inside each partition and written once with
their partition and their place in it.  The driver only adds up one count per
partition; the sums go back as a broadcast of one row per partition.  A run
of equal sort keys is parted by a row number, so no key fills a partition.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

_IN_PARTITION = (1 << 33) - 1  # monotonically_increasing_id counts in the lower 33 bits


def in_range_order(df: DataFrame, order: Sequence[Column | str], name: str = "ordered") -> DataFrame:
    """``df`` written in ``order``: ``__part`` ascends with the order, ``__at`` is the place inside a part."""
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    keys = [*order, F.col("__tie")]
    parted = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie")
    return cut_lineage(parted.withColumns({
        "__part": F.spark_partition_id(),
        "__at": F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))}), name)


def running_bases(per_part: Sequence[tuple[int, int]], start: int) -> list[tuple[int, int]]:
    """(part, rows before it) from (part, rows)."""
    parts = sorted(per_part)
    before = itertools.accumulate((n for _, n in parts), initial=start)
    return [(p, b) for (p, _), b in zip(parts, before)]


def with_ordinal(df: DataFrame, order: Sequence[Column | str], out: str = "ordinal", start: int = 0) -> DataFrame:
    """``df`` plus its 0-based (or ``start``-based) place in the total order ``order``.

    Rows that ``order`` does not tell apart get consecutive places in no
    defined order; give a unique last key where that matters.  NULLs sort as
    the columns of ``order`` say (Spark's default: first ascending).
    """
    placed = in_range_order(df, order)
    spark = df.sparkSession
    counts = [(r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.count("*").alias("n")).collect()]
    bases = spark.createDataFrame(running_bases(counts, start), "__p int, __base bigint")  # one row per partition
    joined = placed.join(F.broadcast(bases), F.col("__part") == F.col("__p"))
    return joined.select(*[placed[c] for c in df.columns], (F.col("__base") + F.col("__at")).alias(out))


def stable_rank(df: DataFrame, score: str, ord_col: str, out: str = "rank") -> DataFrame:
    """SRT5: the 1-based place in Python's ``sorted(key=score, reverse=True)``.

    The sort is stable, so the ordinal of the input breaks ties.  NULL scores
    come last.
    """
    return with_ordinal(df, [F.col(score).desc_nulls_last(), F.col(ord_col).asc()], out, start=1)
