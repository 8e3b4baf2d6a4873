"""Lag and running sums over an unbounded order (WIN3, WIN4).

Rows are written in range partitions (``ordinals.in_range_order``).  A part's
own windows see its rows only; what passes between parts is its border: the last
row's value for a lag, the sum of the parts before for a running sum, the open sum of the
key that runs on for a running sum per key.  The driver adds up one border row per
part; no window is without partitions, and a key that holds any share of the rows is spread
over as many parts as its rows need.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ordinals import in_range_order


def _bordered(placed: DataFrame, borders: list[tuple], fields: list[T.StructField]) -> DataFrame:
    """``placed`` joined to its part's border values (one row per part)."""
    schema = T.StructType([T.StructField("__p", T.IntegerType()), *fields])
    rows = placed.sparkSession.createDataFrame(borders, schema)
    return placed.join(F.broadcast(rows), F.col("__part") == F.col("__p")).drop("__p")


def _in_part(*keys: str) -> Window:
    return Window.partitionBy("__part", *keys).orderBy("__at")


def lag_of(placed: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """``placed`` plus, per ``new: column``, the column's value in the row before; NULL in the first row."""
    last = F.max_by(F.struct(*[F.col(c).alias(n) for n, c in values.items()]), "__at")
    parts = sorted(placed.groupBy("__part").agg(last.alias("last")).collect())  # one row per part
    before = [None, *[tuple(r["last"]) for r in parts[:-1]]]
    fields = [T.StructField(f"__{n}", placed.schema[c].dataType) for n, c in values.items()]
    border = [(r["__part"], *(b or (None,) * len(values))) for r, b in zip(parts, before)]
    joined = _bordered(placed, border, fields)
    # The place decides, not the value: a NULL in the row before stays NULL.
    return joined.select(*placed.columns, *[
        F.when(F.col("__at") == 0, F.col(f"__{n}")).otherwise(F.lag(c).over(_in_part())).alias(n) for n, c in values.items()])


def running_sum_of(placed: DataFrame, value: str, out: str, by: str | None = None) -> DataFrame:
    """``placed`` plus the sum of ``value`` from the first row (of the key ``by``) to the row itself.

    The rows of one key must follow each other in the order.  NULL values add
    nothing (NULL until the first value, as SQL has it), a NULL key is a key.
    Decimal and integer sums are exact.
    """
    key = F.lit(0) if by is None else F.col(by)
    per_key = placed.groupBy("__part", F.struct(key.alias("k")).alias("key")).agg(F.sum(value).alias("s"), F.min("__at").alias("at"))
    parts = sorted(per_key.groupBy("__part").agg(  # one row per part
        F.min_by("key", "at").alias("first"), F.max_by(F.struct("key", "s"), "at").alias("last")).collect())
    border, open_key, open_sum = [], None, None
    for r in parts:
        carried = open_sum if open_key == r["first"] else None
        border.append((r["__part"], r["first"], carried))
        own = r["last"]["s"]
        if r["last"]["key"] == r["first"] and carried is not None:  # one key from end to end
            own = carried if own is None else carried + own
        open_key, open_sum = r["last"]["key"], own
    kind = per_key.schema["s"].dataType
    joined = _bordered(placed, border, [T.StructField("__first", per_key.schema["key"].dataType), T.StructField("__carried", kind)])
    frame = _in_part(*([] if by is None else [by])).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.sum(value).over(frame)
    runs_on = F.struct(key.alias("k")).eqNullSafe(F.col("__first")) & F.col("__carried").isNotNull()
    total = F.when(runs_on, F.col("__carried") + F.coalesce(own, F.lit(0).cast(kind))).otherwise(own)
    return joined.select(*placed.columns, total.cast(kind).alias(out))


def global_lag(df: DataFrame, order: Sequence[Column | str], values: Mapping[str, str]) -> DataFrame:
    """``df`` plus, per ``new: column``, the column's value in the previous row of the order.

    ``order`` should be total; rows that it does not tell apart follow each other in no defined order.
    """
    return lag_of(in_range_order(df, order, "lag"), values).drop("__part", "__at")


def running_sum(df: DataFrame, order: Sequence[Column | str], value: str, out: str, by: str | None = None) -> DataFrame:
    """``df`` plus the running sum of ``value`` in ``order``, started anew for every key ``by``."""
    keys = [] if by is None else [F.col(by).asc_nulls_first()]
    return running_sum_of(in_range_order(df, [*keys, *order], "running"), value, out, by).drop("__part", "__at")
