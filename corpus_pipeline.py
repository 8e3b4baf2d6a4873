"""From raw documents to token-ID files: five stages, each written as Parquet and read by the next.

Every stage gets all rows that its predecessor kept and returns the columns of
``documents``; the last returns the digest of the files that it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import fm_index, line_crf, minhash_inverted, mixing, token_blocks
from tessera.llm.common import saved, table
from tessera.llm.queries import vocabulary


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model scores at least ``line_crf.GOOD``."""
    return line_crf.keep(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group linked by five-word shingles at 80 %."""
    return minhash_inverted.deduplicate(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a test item occurs."""
    return fm_index.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix of its source takes it."""
    return mixing.take(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID files of all that is left, and their digest."""
    return token_blocks.write_and_read(docs, vocabulary())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mix", mix_sources),
    ("token_ids", write_token_ids),
]

#: Classifier, hashing and tokenizer stages have no SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
