"""Plan tests (no nested-loop/cartesian joins, no Python UDFs, pruning,
pushdown, window group limits) and the DuckDB oracle check on sf0.001."""

import duckdb
import pytest

from __spark_entry__ import entry
from tessera.plans import retail as R
from tessera.plans.registry import ORACLE, QUERIES
from tessera.sources import retail as src
from tessera.sources.tables import TABLES, Tables
from tools.oracle_check import rows_of

from .conftest import SF_SMALL

BAD_NODES = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["company_name", "phone", "country", "mitja_compra", "client_tier"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_bad_plan_nodes(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for node in BAD_NODES:
        assert node not in plan, f"{name} plans {node}"


def test_column_pruning_and_pushdown(spark):
    t = Tables(spark, SF_SMALL)
    recent = src.transactions(t, False).filter("timestamp >= timestamp_ntz'2001-07-01 00:00:00'")
    plan = _plan(R.companies_without_transactions(src.companies(t), recent))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_rank_filter_becomes_window_group_limit(spark):
    assert "WindowGroupLimit" in _plan(QUERIES["active_cards"](spark, SF_SMALL))
    assert "WindowGroupLimit" in _plan(QUERIES["third_purchase"](spark, SF_SMALL))


def test_uncorrelated_exists_is_a_subquery_not_a_join(spark):
    plan = _plan(QUERIES["transactions_if_country_exists"](spark, SF_SMALL))
    assert "Subquery" in plan and "BroadcastNestedLoopJoin" not in plan


def test_partition_pruning_on_recent_fact(spark):
    plan = _plan(QUERIES["recent_30_days"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(date" in plan


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_matches(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.execute(ORACLE[name])
    dcols = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, rel.fetchall())
