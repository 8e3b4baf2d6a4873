"""Session construction and the shared scratch folder.

The only place configuration lives.  On a cluster the session is handed to
us already built: we then only read ``spark.checkpoint.dir`` and never set
machine-local paths.  ``get_session`` is for tests, the bench and local use.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only below a fixed size; AQE re-plans with runtime sizes.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    on a ``local[...]`` master (tests, bench) a private folder under the
    system temp dir is made; on a cluster it must be named, as executors do
    not share the driver's disk.  The context's folder is set once.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = local_scratch(spark.sparkContext.master)
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def local_scratch(master: str) -> str:
    """A private folder for a local master; refused for any other.  Removed when Python ends."""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="tessera-ckpt-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera/{name}/{uuid.uuid4().hex}"


def cut_lineage(df, name: str = "stage"):
    """Write ``df`` as Parquet under the shared scratch folder and read it back.

    What follows starts at the written files (a lost executor costs no
    recomputation) and, unlike a checkpointed RDD, its scans are pruned.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
