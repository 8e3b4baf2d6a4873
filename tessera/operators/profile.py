"""Profiling (AGG17-AGG20, PRF1-PRF3).

Each report is *one* aggregate over the data (all columns at once), then an
``unpivot`` of the one-row result — a single scan regardless of width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.order_stats import exact_quantiles
from tessera.session import cut_lineage

_NUM = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _q(c: str) -> str:
    return f"`{c}`"


def null_counts(df: DataFrame, only_positive: bool = True, with_infinite: bool = False) -> DataFrame:
    """AGG18/PRF3: NULL (and optional infinite) count per column → rows."""
    aggs = [F.count_if(F.col(_q(c)).isNull()).alias(c) for c in df.columns]
    one = df.agg(*aggs)
    out = one.unpivot([], df.columns, "column", "nulls")
    if with_infinite:
        num = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
        inf = df.agg(*[F.count_if(F.abs(F.col(_q(c))) == float("inf")).alias(c) for c in num]) \
            .unpivot([], num, "column", "infinite") if num else None
        out = out.join(inf, "column", "left").fillna(0, ["infinite"]) if inf is not None \
            else out.withColumn("infinite", F.lit(0).cast("bigint"))
    return out.filter(F.col("nulls") > 0) if only_positive else out


def duplicate_counts(df: DataFrame, key: str | None = None) -> DataFrame:
    """AGG17: ``duplicated().sum()`` for whole rows and for a key, as rows
    ``(metric, value)``.

    pandas treats NULL keys as equal, so this groups (NULL is one group) and
    sums ``count - 1`` — a partial aggregate, safe for hot keys.
    """
    def dup(cols, name):
        return df.groupBy(*cols).count().agg(
            F.lit(name).alias("metric"),
            F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("value"))
    out = dup([_q(c) for c in df.columns], "duplicate_rows")
    return out if key is None else out.unionByName(dup([key], "duplicate_keys"))


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG19: pandas ``describe``: numeric moments with interpolated quartiles
    and, for text, count / unique / top / freq.

    Output ``(column, stat, value double, text)``; ``text`` holds ``top`` only.
    All numeric columns are one aggregate; the exact quartiles come from
    refining histograms, so no column's values are held together.
    """
    cols = list(cols or df.columns)
    fields = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in cols if isinstance(fields[c], _NUM)]
    parts = []
    if num:
        def stats(i, c):
            x = F.col(_q(c)).cast("double")
            return [F.count(x).cast("double").alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev(x).alias(f"s{i}"),
                    F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        quartiles = exact_quantiles(df, [], {f"q{i}": F.col(_q(c)) for i, c in enumerate(num)}, [0.25, 0.5, 0.75])
        one = df.agg(*[a for i, c in enumerate(num) for a in stats(i, c)]).withColumn(
            "q", quartiles.select(F.struct(*quartiles.columns)).scalar()).select("*", "q.*")
        rows = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("stat"), v.alias("value"))
                for i, c in enumerate(num) for k, v in (
                    ("count", F.col(f"n{i}")), ("mean", F.col(f"m{i}")), ("std", F.col(f"s{i}")), ("min", F.col(f"lo{i}")),
                    ("25%", F.col(f"q{i}")[0]), ("50%", F.col(f"q{i}")[1]), ("75%", F.col(f"q{i}")[2]), ("max", F.col(f"hi{i}")))]
        parts.append(one.select(F.explode(F.array(*rows)).alias("r")).select(
            "r.column", "r.stat", "r.value", F.lit(None).cast("string").alias("text")))
    for c in (c for c in cols if c not in num):
        counts = df.where(F.col(_q(c)).isNotNull()).groupBy(F.col(_q(c)).cast("string").alias("v")).count()
        row = counts.agg(F.sum("count").cast("double").alias("count"), F.count("v").cast("double").alias("unique"),
                         F.min_by("v", F.struct(-F.col("count"), F.col("v"))).alias("top"),
                         F.max("count").cast("double").alias("freq"))
        none = F.lit(None)
        parts.append(row.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.lit(k).alias("stat"),
                     (none.cast("double") if k == "top" else F.col(k)).alias("value"),
                     (F.col(k) if k == "top" else none.cast("string")).alias("text"))
            for k in ("count", "unique", "top", "freq")])).alias("s")).select("s.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sample_rows(df: DataFrame, ord_col: str, n: int = 5) -> DataFrame:
    """AGG20/PRF2: the first ``n`` rows in input order (``head``)."""
    return df.orderBy(ord_col).limit(n)


def shape_report(df: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """AGG20: rows, columns and (optionally) rows removed against ``before``,
    as ``(metric, value)`` rows."""
    r = df.agg(F.lit("rows").alias("metric"), F.count("*").alias("value")) \
        .unionByName(df.limit(0).agg(F.lit("columns").alias("metric"),
                                     F.lit(len(df.columns)).cast("bigint").alias("value")))
    if before is not None:
        r = r.unionByName(before.agg(F.lit("rows_before").alias("metric"),
                                     F.count("*").alias("value")))
    return r


def column_report(df: DataFrame) -> DataFrame:
    """AGG20: type and non-NULL count per column, ``(metric, column, value, text)``; one scan."""
    counts = df.agg(*[F.count(_q(c)).alias(c) for c in df.columns]).unpivot([], [F.col(_q(c)) for c in df.columns], "column", "value")
    types = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, t)])
    return counts.select(F.lit("non_null").alias("metric"), "column", "value", types[F.col("column")].alias("text"))


def exploration_report(df: DataFrame, key: str | None = None) -> DataFrame:
    """PRF2: shape, duplicate rows and keys, then type and non-NULL count of
    every column, as ``(metric, column, value, text)``."""
    none = F.lit(None).cast("string")
    shape = shape_report(df).unionByName(duplicate_counts(df, key))
    return shape.select("metric", none.alias("column"), "value", none.alias("text")).unionByName(column_report(df))


TRACKED = 8192  # items that the sketch of a column follows


def sketch_error(n: int, tracked: int = TRACKED) -> float:
    """A value that occurs more often than this is among the sketch's items, whatever the rest (n rows).

    The frequent-items sketch keeps a map of the next power of two above
    tracked / 0.75 and errs by at most 3.5 rows in so many.
    """
    width = 1 << (int(tracked / 0.75) - 1).bit_length()
    return 3.5 * n / width


def frequent_values(df: DataFrame, cols: Sequence[str], top: int, tracked: int = TRACKED) -> DataFrame:
    """AGG14/PRF1: ``(column, bucket, freq)`` of the ``top`` most frequent values of each text column, NULL as 'nan',
    ties by value.  Exact.

    One aggregate sketches all columns in bounded memory; its items are counted
    again exactly.  Where the ``top``-th of them occurs more often than the sketch can have
    overlooked, no other value can be among the top; the other columns
    (nearly all values differ) are counted in full.
    """
    text = {c: F.coalesce(F.col(_q(c)).cast("string"), F.lit("nan")) for c in cols}
    found = df.agg(F.count("*").alias("n"), *[
        F.call_function("approx_top_k", text[c], F.lit(tracked), F.lit(tracked)).alias(f"k{i}") for i, c in enumerate(cols)]).first()  # bounded by ``tracked``
    least = sketch_error(found["n"], tracked)
    items = [(c, r["item"]) for i, c in enumerate(cols) for r in found[f"k{i}"] or () if r["count"] > 0]
    spark = df.sparkSession
    long = df.select(*[text[c].alias(c) for c in cols]).unpivot([], [F.col(_q(c)) for c in cols], "column", "bucket")
    order = Window.partitionBy("column").orderBy(F.desc("freq"), "bucket")

    def best(counts: DataFrame) -> DataFrame:
        return counts.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= top)

    named = spark.createDataFrame(items, "c string, v string")
    known = best(long.join(F.broadcast(named), (F.col("column") == F.col("c")) & (F.col("bucket") == F.col("v")))
                 .groupBy("column", "bucket").agg(F.count("*").alias("freq")))
    rows = cut_lineage(known, "frequent")
    last = {r["column"]: (r["n"], r["least"], r["all"]) for r in rows.groupBy("column").agg(
        F.count("*").alias("n"), F.min("freq").alias("least"), F.sum("freq").alias("all")).collect()}  # one row per column
    # Proven: enough values above the error, or the values counted are all there are.
    counted = {c: sum(1 for k, _ in items if k == c) for c in cols}
    proven = [c for c in cols if c in last and ((last[c][0] >= top and last[c][1] > least)
                                                or (counted[c] <= top and last[c][2] == found["n"]))]
    open_ = [c for c in cols if c not in proven]
    out = rows.where(F.col("column").isin(proven)).select("column", "bucket", "freq")
    if open_:
        full = long.where(F.col("column").isin(open_)).groupBy("column", "bucket").agg(F.count("*").alias("freq"))
        out = out.unionByName(best(full).select("column", "bucket", "freq"))
    return out


def profile_table(df: DataFrame, top: int = 10, bins: int = 10) -> DataFrame:
    """PRF1 re-aimed: a profile table ``(column, kind, bucket, freq)``.

    date/timestamp → top years; numeric → fixed-width histogram between the
    column's min and max; anything else → top values as text (NULL → 'nan').
    One unpivot per kind (all columns of a kind in one pass), then one
    aggregate per kind; the top values come from ``frequent_values``.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    dates = [c for c, t in fields.items() if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    nums = [c for c, t in fields.items() if isinstance(t, _NUM)]
    texts = [c for c in df.columns if c not in dates and c not in nums]
    parts = []

    if dates:
        long = df.select(*[F.year(_q(c)).cast("string").alias(c) for c in dates]) \
            .unpivot([], dates, "column", "bucket").filter(F.col("bucket").isNotNull())
        counts = long.groupBy("column", "bucket").agg(F.count("*").alias("freq"))  # one row per year
        place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("freq"), "bucket"))
        parts.append(counts.withColumn("_r", place).where(F.col("_r") <= top).withColumn("kind", F.lit("year")))
    if texts:
        parts.append(frequent_values(df, texts, top).withColumn("kind", F.lit("top_value")))
    if nums:
        stats = df.agg(*[F.min(_q(c)).cast("double").alias(f"lo_{i}") for i, c in enumerate(nums)],
                       *[F.max(_q(c)).cast("double").alias(f"hi_{i}") for i, c in enumerate(nums)])
        long = df.select(*[F.col(_q(c)).cast("double").alias(c) for c in nums]) \
            .unpivot([], nums, "column", "v").filter(F.col("v").isNotNull())
        bounds = stats.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"lo_{i}").alias("lo"), F.col(f"hi_{i}").alias("hi"))
            for i, c in enumerate(nums)])).alias("b")).select("b.*")
        j = long.join(F.broadcast(bounds), "column")  # one row per numeric column
        width = (F.col("hi") - F.col("lo")) / bins
        idx = F.least(F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("lo"), width)), F.lit(0)),
                      F.lit(bins - 1)).cast("int")
        parts.append(j.groupBy("column", F.format_string("%02d", idx).alias("bucket"))
                     .agg(F.count("*").alias("freq")).withColumn("kind", F.lit("histogram")))
    out = parts[0].select("column", "kind", "bucket", "freq")
    for p in parts[1:]:
        out = out.unionByName(p.select("column", "kind", "bucket", "freq"))
    return out
