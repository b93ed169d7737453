"""Every registered query: runs on sf0.001, matches its DuckDB oracle, stays JVM-side."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from zoneflow.plans import oracles, queries as catalogue
from tests.conftest import SMOKE_DIR
from tests.oracle_check import compare, duck

QUERIES = catalogue.QUERIES   # those of the training-data operators have their own tests
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracles.ORACLES) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_without_python_udfs(spark, con, name):
    df = QUERIES[name](spark, SMOKE_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    ok, msg = compare(spark, con, SMOKE_DIR, name, QUERIES[name], ORACLES.get(name), sdf=df)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["season", "n_rows"] and len(rows) > 0
    assert sum(r.n_rows for r in rows) == spark.read.parquet(f"{SMOKE_DIR}/orders.parquet").count()


def test_season_exclude_prunes_partitions(spark):
    df = QUERIES["season_exclude"](spark, SMOKE_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "1999-00" in plan.split("PartitionFilters: [")[1].split("]")[0]
