"""Small tables with every awkward row, shared by the operator tests."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns that operators use inside, here as strangers.
STRANGERS = ["id", "row", "kind", "size", "place", "score", "copies", "cut", "class", "component", "spans", "n_words"]

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly examine old maps of the northern coast"


def rows():
    long = " ".join(f"word{i % 977} tail{i % 31}" for i in range(30_000))
    return [
        (1, PROSE, "a"), (2, PROSE, "a"), (2, PROSE, "a"),  # a copy, and a repeated row
        (3, PROSE.replace("old maps", "new maps"), "b"), (4, None, "a"), (5, "", "b"), (6, " \t\n ", None),
        (7, "one", None), (8, long, "a"), (9, long + " end", "c"), (None, "text without id", "c"), (None, None, None),
        (10, "Ünïcödé — 漢字 ﬁné İstanbul Σίσυφος <|endoftext|> 'll we're", "b"), (11, "x" * 5000, "c"), (12, "a\nb\n\nc", "a"),
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    """documents with nulls, empties, ties, repeats, a long text, and clashing extra columns."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("source", T.StringType())])
    df = spark.createDataFrame(rows(), schema)
    return df.withColumns({c: F.lit("stranger") for c in STRANGERS}).repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def few_labels(spark):
    data = [(i, i % 2, (i + 1) % 2) for i in [1, 2, 3, 7, 8, 12, 404]] + [(None, 1, 1), (4, None, None)]
    return spark.createDataFrame(data, "doc_id bigint, quality int, toxic int")
