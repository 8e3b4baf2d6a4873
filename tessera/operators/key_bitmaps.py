"""Exact distinct counts and referential checks on integer keys by bitmaps (DQ1, DQ3, AGG1).

A key is one bit: its bucket (32,768 keys) names a 4 KB bitmap, its position the bit.
Building the bitmaps is a partial aggregate, so every task sends one bitmap per
bucket instead of its keys, and a hot key is one bit.  Distinct keys are
counted bits; a child's keys without parent are the bits that the union of both has
more than the parent; a row is an orphan where its bit is not set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_bitmaps(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(fk, bucket, bits)`` of every integer column in ``keys``; one scan, one shuffle of bitmaps.  NULL has no bit."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("fk"), F.col(k).cast("bigint").alias("key")) for k in keys]))
    long = df.select(each.alias("e")).select("e.*").where("key is not null")
    return long.groupBy("fk", F.bitmap_bucket_number("key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits"))


def has_key(bits: Column, key: Column) -> Column:
    """Whether the key's bit is set in its bucket's bitmap; false where there is no bitmap."""
    at = F.bitmap_bit_position(key).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    shifted = F.call_function("shiftright", byte, F.pmod(at, F.lit(8)))
    return F.coalesce(shifted.bitwiseAND(F.lit(1)) == 1, F.lit(False))


def _parents(fks: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(fk, bucket, bits)`` of the parents' keys."""
    each = [key_bitmaps(p.select(F.col(pk).alias(fk)), [fk]) for fk, (p, pk) in fks.items()]
    return reduce(DataFrame.unionByName, each)


def key_report(child: DataFrame, fks: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(fk, distinct_keys, orphan_keys)``: exact counts; the child is read once and sends bitmaps only."""
    own = key_bitmaps(child, list(fks)).withColumn("side", F.lit("child"))
    both = own.unionByName(_parents(fks).withColumn("side", F.lit("parent")))
    per = both.groupBy("fk", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("either"),
        F.sum(F.when(F.col("side") == "child", F.bitmap_count("bits"))).alias("child"),
        F.sum(F.when(F.col("side") == "parent", F.bitmap_count("bits"))).alias("parent"))
    names = child.sparkSession.createDataFrame([(fk,) for fk in fks], "name string")
    counts = per.groupBy("fk").agg(F.sum("child").alias("distinct_keys"),
                                   F.sum(F.col("either") - F.coalesce("parent", F.lit(0))).alias("orphan_keys"))
    zero = F.lit(0).cast("bigint")
    return names.join(counts, F.col("name") == F.col("fk"), "left").select(
        F.col("name").alias("fk"), F.coalesce("distinct_keys", zero).alias("distinct_keys"), F.coalesce("orphan_keys", zero).alias("orphan_keys"))


def orphan_rows(child: DataFrame, fks: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """DQ3: ``(fk, orphan_rows)``; the child's rows meet bitmaps (one bit per parent key), not the parents' rows."""
    joined, flags = child.select(*fks), {}
    for i, (fk, (parent, pk)) in enumerate(fks.items()):
        maps = key_bitmaps(parent.select(F.col(pk).alias("k")), ["k"]).select(F.col("bucket").alias(f"_b{i}"), F.col("bits").alias(f"_bits{i}"))
        joined = joined.join(maps, F.bitmap_bucket_number(F.col(fk).cast("bigint")) == F.col(f"_b{i}"), "left")
        flags[fk] = F.count_if(F.col(fk).isNotNull() & ~has_key(F.col(f"_bits{i}"), F.col(fk).cast("bigint")))
    one = joined.agg(*[n.alias(fk) for fk, n in flags.items()])
    return one.unpivot([], list(fks), "fk", "orphan_rows")
