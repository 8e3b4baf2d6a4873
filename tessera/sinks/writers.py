"""Writers (SNK1-SNK8).

Every write goes to a path the caller chooses — on a cluster a shared
folder, typically under ``spark.checkpoint.dir`` (see ``session.scratch_dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import label_no_spaces


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """SNK1/SNK5: create-or-replace (``CTAS`` / truncate + reload)."""
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def save_as_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 64,
                  partition_by: str | None = None) -> str:
    """SNK1/SNK2 (catalog): managed table, optionally bucketed by the
    clustering key so later joins on it are co-located without a shuffle."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(partition_by)
    if bucket_by:
        w = w.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    w.saveAsTable(name)
    return name


def view(df: DataFrame, name: str) -> str:
    """SNK3: logical view; an ``ORDER BY`` inside it is not kept — sort on read."""
    df.createOrReplaceTempView(name)
    return name


def refresh_daily_partitions(daily: DataFrame, path: str, date_col: str = "fecha") -> str:
    """SNK4: the materialised daily aggregate, partitioned by date; with
    ``partitionOverwriteMode=dynamic`` only the dates present are replaced,
    so a refresh rewrites touched days only."""
    (daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))
    return path


def group_files(df: DataFrame, group: str, prefix: str = "dades_") -> DataFrame:
    """``(_label, _file)``: the folder of every label, its blanks removed.

    Labels that differ by blanks only would share a folder, so all but the
    first of them (in label order) get a number.
    """
    base = F.concat(F.lit(prefix), label_no_spaces(F.col("_label")))
    labels = df.select(F.col(group).cast("string").alias("_label")).where("_label is not null").distinct().withColumn("_base", base)
    place = F.row_number().over(Window.partitionBy("_base").orderBy("_label"))
    return labels.withColumn("_n", place).select(
        "_label", F.when(F.col("_n") == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("_"), F.col("_n").cast("string"))).alias("_file"))


def export_per_group(df: DataFrame, group: str, path: str, prefix: str = "dades_") -> str:
    """SNK6: one folder of CSV per group in one pass (``partitionBy``).

    Rows with a NULL group are dropped first.  ``partitionBy`` takes the
    column out of the files, so a copy under the original name is kept and
    the folder name comes from ``group_files``.
    """
    d = df.join(group_files(df, group, prefix), F.col(group).cast("string") == F.col("_label")).drop("_label")
    # rebalance: a large group becomes several files, none waits for one task
    (d.hint("rebalance", F.col("_file")).write.mode("overwrite").option("header", True)
     .partitionBy("_file").csv(path))
    return path


def export_single_csv(df: DataFrame, path: str) -> str:
    """SNK7: one CSV file.  Only for aggregates whose rows are bounded by their groups: one task writes it."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def export_bundle(summary: DataFrame, detail: DataFrame, group: str, root: str) -> str:
    """SNK8 re-aimed: one output root holding ``resumen_agregado/`` and one
    ``grup=<label>/`` directory per group (instead of one multi-sheet file)."""
    export_single_csv(summary, f"{root}/resumen_agregado")
    d = detail.filter(F.col(group).isNotNull()).withColumn("grup", F.col(group))
    d.hint("rebalance", F.col("grup")).write.mode("overwrite").option("header", True).partitionBy("grup") \
        .csv(f"{root}/grups")
    return root
