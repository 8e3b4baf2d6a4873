"""Insert, update and delete by key on a large table (MUT1-MUT5, SNK5).

The rows are dealt to hash buckets of the key, one folder each.  A set of
changes touches the buckets of its keys only: these are read, joined with the
changes and written as a new version of the bucket; the files of all other buckets
stay as they are.  A log of (bucket, version) says what the table is; it is
appended last, so readers see all changes of a set or none, and a job that
dies leaves the old table.

A set holds at most one change per key: repeated keys are refused, as are
inserts of keys that exist.  Updates and deletes of keys that do not exist do
nothing, as in SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage

INSERT, UPDATE, DELETE = "insert", "update", "delete"
_LOG = "bucket int, version bigint, folder string"


class ChangeRefusedError(ValueError):
    """The set of changes has repeated, missing or already used keys."""


class KeyedTable:
    """A table below ``root`` in ``buckets`` hash buckets of ``key``."""

    def __init__(self, spark: SparkSession, root: str, key: str, schema: T.StructType, buckets: int):
        self.spark, self.root, self.key, self.schema, self.buckets = spark, root, key, schema, buckets

    @classmethod
    def create(cls, df: DataFrame, root: str, key: str, buckets: int = 64) -> KeyedTable:
        """Write ``df`` as the first version (SNK5: a new root is a reload)."""
        table = cls(df.sparkSession, root, key, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]), buckets)
        table._write(df, range(buckets), 1)
        return table

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, touched: Sequence[int], version: int) -> None:
        folder = f"data/{uuid.uuid4().hex}"
        path = f"{self.root}/{folder}"
        df.withColumn("_bucket", self._bucket(F.col(self.key))).hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(path)
        written = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(path)
        filled = {r[0] for r in written.select("_bucket").distinct().collect()}  # at most ``buckets``
        log = [(b, version, f"{folder}/_bucket={b}" if b in filled else None) for b in touched]
        self.spark.createDataFrame(log, _LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/_log")

    def _folders(self) -> dict[int, tuple[int, str | None]]:
        """Version and folder of every bucket."""
        log = self.spark.read.schema(_LOG).parquet(f"{self.root}/_log")
        last = log.groupBy("bucket").agg(F.max_by(F.struct("version", "folder"), "version").alias("at"))
        return {r["bucket"]: (r["at"]["version"], r["at"]["folder"]) for r in last.collect()}  # at most ``buckets``

    def _rows(self, folders: Sequence[str | None]) -> DataFrame:
        paths = [f"{self.root}/{f}" for f in folders if f]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        """The table as it is now."""
        return self._rows([f for _, f in self._folders().values()])

    def apply(self, changes: DataFrame, op_col: str = "op", sets: Sequence[str] | None = None) -> dict[str, int]:
        """Apply a set of changes: ``op``, the key and columns of the table.

        An insert takes all columns that ``changes`` has, the others are NULL; an
        update sets the columns ``sets`` (default: all that ``changes`` has), also
        to NULL.  Returns the number of rows inserted, updated and deleted, and of
        buckets rewritten.
        """
        key = self.key
        given = cut_lineage(changes.withColumn("_to", self._bucket(F.col(key))), "changes")
        bad = given.groupBy(key).agg(F.count("*").alias("n"), F.max(~F.col(op_col).isin(INSERT, UPDATE, DELETE)).alias("odd")).where(
            (F.col("n") > 1) | F.col(key).isNull() | F.coalesce("odd", F.lit(True))).limit(5).collect()
        if bad:
            raise ChangeRefusedError(f"repeated or NULL keys, or unknown operations: {[r[key] for r in bad]}")
        touched = sorted(r[0] for r in given.select("_to").distinct().collect())  # at most ``buckets``
        if not touched:
            return {INSERT: 0, UPDATE: 0, DELETE: 0, "buckets": 0}
        folders = self._folders()
        old = self._rows([folders[b][1] for b in touched])
        columns = old.columns
        new = given.select(F.col(key).alias("_key"), F.col(op_col).alias("_op"),
                           *[F.col(c).alias(f"_new_{c}") for c in columns if c in given.columns])
        joined = cut_lineage(old.withColumn("_old", F.lit(True)).join(new, F.col(key) == F.col("_key"), "full"), "changed")
        taken = joined.where(F.col("_old") & (F.col("_op") == INSERT)).select(key).limit(5).collect()
        if taken:
            raise ChangeRefusedError(f"keys that exist: {[r[0] for r in taken]}")
        kept = joined.where(F.col("_old") & F.coalesce(F.col("_op") != DELETE, F.lit(True)) | (F.col("_op") == INSERT))
        setting = [c for c in columns if c in given.columns and c != key and (sets is None or c in sets)]

        def value(c: str) -> Column:
            fresh = F.col("_key") if c == key else F.col(f"_new_{c}") if c in given.columns else F.lit(None)
            out = F.when(F.col("_op") == INSERT, fresh)
            if c in setting:
                out = out.when(F.col("_op") == UPDATE, F.col(f"_new_{c}"))
            return out.otherwise(F.col(c)).alias(c)

        counts = joined.agg(*[F.count_if((F.col("_op") == op) & (F.lit(True) if op == INSERT else F.col("_old"))).alias(op)
                              for op in (INSERT, UPDATE, DELETE)]).first().asDict()
        version = max(v for v, _ in folders.values()) + 1
        self._write(kept.select(*[value(c) for c in columns]), touched, version)
        return {**counts, "buckets": len(touched)}
