"""Checks in the pass that writes (DQ1-DQ4): a table is published only if they hold.

``observe`` counts violations while the rows are written, so the checks cost no
second scan.  A version is written to a folder of its own; what readers see is the
last line of a small log, which is appended only after the checks, so a
violation or a lost job leaves the old table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOG = "version bigint, folder string"


class ChecksFailedError(ValueError):
    """Some check counted violations; ``metrics`` has all counts."""

    def __init__(self, metrics: Mapping[str, int]):
        self.metrics = dict(metrics)
        super().__init__(f"violations: { {k: v for k, v in metrics.items() if v and k != 'rows'} }")


@dataclass
class Published:
    root: str
    version: int
    metrics: dict[str, int]


def not_null(*columns: str) -> dict[str, Column]:
    """DQ2: NULLs per column."""
    return {f"null_{c}": F.count_if(F.col(c).isNull()) for c in columns}


def without_parent(flags: Mapping[str, Column]) -> dict[str, Column]:
    """DQ3: rows whose key has no parent, by a flag that a join (or a key bitmap) has set."""
    return {f"orphan_{c}": F.count_if(~flag) for c, flag in flags.items()}


def in_range(column: str, low, high) -> dict[str, Column]:
    """Rows outside ``low..high``."""
    return {f"range_{column}": F.count_if(~F.col(column).between(low, high))}


def _versions(spark: SparkSession, root: str) -> list:
    try:
        log = spark.read.schema(_LOG).parquet(f"{root}/_published")
    except AnalysisException:  # nothing published yet
        return []
    return log.orderBy(F.desc("version")).limit(1).collect()


def publish(spark: SparkSession, root: str, folder: str) -> int:
    """Make ``folder`` (below ``root``) the table; returns its version."""
    last = _versions(spark, root)
    version = last[0]["version"] + 1 if last else 1
    spark.createDataFrame([(version, folder)], _LOG).coalesce(1).write.mode("append").parquet(f"{root}/_published")
    return version


def write_checked(df: DataFrame, root: str, checks: Mapping[str, Column], drop: tuple[str, ...] = (),
                  partition_by: tuple[str, ...] = ()) -> Published:
    """Write ``df`` without the columns ``drop`` as the next version, if no check counts a violation.

    ``checks`` are aggregates that count violations; columns that only they need may be dropped.
    """
    seen = Observation()
    folder = f"data/{uuid.uuid4().hex}"
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in checks.items()]).drop(*drop)
    observed.write.partitionBy(*partition_by).parquet(f"{root}/{folder}")
    metrics = {k: int(v or 0) for k, v in seen.get.items()}
    if any(v for k, v in metrics.items() if k != "rows"):
        raise ChecksFailedError(metrics)
    return Published(root, publish(df.sparkSession, root, folder), metrics)


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The last published version."""
    last = _versions(spark, root)
    if not last:
        raise FileNotFoundError(f"nothing is published below {root}")
    return spark.read.parquet(f"{root}/{last[0]['folder']}")
