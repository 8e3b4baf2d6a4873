"""The operators' queries against their DuckDB SQL."""

import duckdb
import pytest

from tessera.llm.queries import ORACLE, QUERIES
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_matches(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    rel = duck.execute(ORACLE[name])
    columns = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, got) == rows_of(columns, rel.fetchall())
