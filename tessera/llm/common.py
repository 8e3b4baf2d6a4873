"""Small helpers shared by the operators: columns, folds, words, scratch tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, scratch_dir

SPACE = b" \t\n\x0b\x0c\r"
#: Byte table that keeps 0-9, a-z and everything beyond ASCII, and blanks the rest (after ASCII lower-casing).
_KEEP = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table by name; also makes sure that the shared scratch folder is known."""
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: what follows survives lost executors without running
    ``df`` again, and reads only the columns it needs.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def blank_words(text: bytes) -> list[bytes]:
    r"""ASCII-lower-cased words ``[^\x20\x09-\x0D]+``."""
    return text.lower().split()


def plain_words(text: bytes) -> list[bytes]:
    r"""ASCII-lower-cased words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``."""
    return text.lower().translate(_KEEP).split()


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most_bytes`` of ``column`` (one row at least), so memory stays bounded."""
    for batch in batches:
        size = batch.column(column).nbytes
        if size <= most_bytes or batch.num_rows <= 1:
            yield batch
            continue
        step, start = max(1, int(batch.num_rows * most_bytes / size)), 0
        while start < batch.num_rows:
            yield batch.slice(start, step)
            start += step
