r"""Mixing sources to target weights, native.

A document's place is a fixed hash of its id in [0, 2^60).  A source whose
target is ``k`` full copies and a remainder takes every document ``k`` times
and once more those whose place lies below the source's cut.  The cut is found
without sorting documents: sizes are summed by source and hash bucket, the
running sum over at most 4,096 buckets names the bucket in which the remainder
ends, and only that bucket is summed again at the next 12 bits, five times in
all.  Cuts of nested budgets are nested, so a larger budget keeps what a
smaller one took.

Defined cases: null text has size 0; a null source is a source of its own,
last in order; a null id hashes as the empty text; rows that share an id share
a place and are taken alike; an empty table gives an empty mix; a source
without words has target 0.  Input columns other than those named are ignored
by ``plan`` and carried by ``take``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import saved

PLACE_BITS, LEVEL_BITS = 60, 12
#: A per-source table of up to this many rows is broadcast (under 100 bytes a row); a larger one is shuffled.
BROADCAST_SOURCES = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def place(id_col: Column) -> Column:
    """The first 60 bits of the id's md5 as a number."""
    digest = F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, PLACE_BITS // 4), 16, 10).cast("long")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """One row per source: size, target, full copies, remainder.

    Sources in code point order weigh ``weights`` in turn.  A target stops at
    ``cap`` times the source's size and the excess is shared again by weight.
    In order of size per weight the capped sources are a prefix, so the level
    of the rest comes from running sums over the per-source table.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = per.withColumn("weight", F.element_at(
        cycle, ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int")))
    by_need = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    level = ((F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
             / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    share = ranked.withColumn("level", level).withColumn(
        "free", F.col("level") * F.col("weight") < cap * F.col("source_size"))
    # The first source that its share does not fill sets the level of all that follow.
    found = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(
        by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(cap * F.col("source_size"), F.coalesce(found, F.lit(0.0)) * F.col("weight")).cast("double")
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return (share.withColumn("target", target).withColumn("copies", copies.cast("long"))
            .withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
            .select("source", "source_size", "target", "copies", "rest"))


def _small(df: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(df) if few else df


def source_cuts(sized: DataFrame, targets: DataFrame, few: bool) -> DataFrame:
    """``targets`` plus ``cut``: documents placed below it are taken once more.

    ``prefix`` is the bucket that holds the end of the remainder, ``base`` the
    words before it.  Each level reads the state of the level above once.  A
    source whose remainder no bucket passes leaves the chain: all of it is taken.
    """
    state = targets.select(F.col("source").alias("s_source"), "rest", F.lit(0).cast("long").alias("prefix"),
                           F.lit(0).cast("long").alias("base"))
    for bits in range(LEVEL_BITS, PLACE_BITS + 1, LEVEL_BITS):
        shift = PLACE_BITS - bits
        inside = sized.join(_small(state, few), sized["source"].eqNullSafe(state["s_source"])).where(
            F.shiftright("place", shift + LEVEL_BITS) == F.col("prefix"))
        hist = inside.groupBy("source", F.shiftright("place", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.first("base").alias("base"), F.first("rest").alias("rest"))
        upto = F.col("base") + F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        state = (hist.withColumn("upto", upto).where(F.col("upto") > F.col("rest")).groupBy("source")
                 .agg(F.min(F.struct("bucket", "upto", "words", "rest")).alias("end"))
                 .select(F.col("source").alias("s_source"), F.col("end.rest").alias("rest"),
                         F.col("end.bucket").alias("prefix"),
                         (F.col("end.upto") - F.col("end.words")).alias("base"), F.col("end.words").alias("words")))
    # The last bucket is one place; take it too if that comes nearer to the target.
    nearer = F.col("base") + F.col("words") - F.col("rest") < F.col("rest") - F.col("base")
    ends = state.select("s_source", (F.col("prefix") + F.when(nearer, 1).otherwise(0)).alias("cut"))
    return (targets.join(_small(ends, few), targets["source"].eqNullSafe(F.col("s_source")), "left")
            .select("source", "source_size", "target", "copies",
                    F.coalesce("cut", F.lit(1 << PLACE_BITS)).alias("cut")))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: Sequence[float] = (1, 2, 3), cap: int = 3) -> tuple[DataFrame, DataFrame, bool]:
    """Sizes per document, cuts per source, and whether the cuts may be broadcast (their count is checked)."""
    sized = saved(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                              n_words(F.col(text_col)).alias("size"), place(F.col(id_col)).alias("place")),
                  "mix-sizes")
    targets = saved(source_targets(sized, weights, cap), "mix-targets")
    few = targets.count() <= BROADCAST_SOURCES
    return sized, saved(source_cuts(sized, targets, few), "mix-cuts"), few


def mix(docs: DataFrame, **kwargs) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies, taken."""
    sized, cuts, few = plan(docs, **kwargs)
    cuts = cuts.withColumnRenamed("source", "c_source")
    copies = F.col("copies") + F.when(F.col("place") < F.col("cut"), 1).otherwise(0)
    return (sized.join(_small(cuts, few), sized["source"].eqNullSafe(F.col("c_source")), "left")
            .select("doc_id", "source", "size", "source_size", "target",
                    copies.alias("copies"), (copies * F.col("size")).alias("taken")))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: Sequence[float] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """The mixed rows themselves: every column of ``docs``, each row as often as the mix takes it."""
    _, cuts, few = plan(docs, id_col, text_col, source_col, weights, cap)
    cuts = cuts.select(F.struct("copies", "cut").alias("__mix_cut"), F.col("source").alias("__mix_source"))
    joined = docs.join(_small(cuts, few), docs[source_col].eqNullSafe(F.col("__mix_source")))
    n = (F.col("__mix_cut.copies") + F.when(place(docs[id_col]) < F.col("__mix_cut.cut"), 1).otherwise(0)).cast("int")
    times = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return joined.select(*[docs[c] for c in docs.columns], F.explode(times).alias("__mix_copy")).drop("__mix_copy")
