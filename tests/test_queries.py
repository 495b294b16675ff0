"""Every SQL-checked query on the smallest tables, and what no plan may contain."""

import duckdb
import pytest

from queries import registry
from queries.check import compare
from queries.views import TABLES

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf):
    made = duckdb.connect()
    for table in TABLES:
        made.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    return made


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, sf, connection, name):
    outcome = compare(spark, connection, sf, name, QUERIES, ORACLES)
    assert outcome.startswith("ok") and "types" not in outcome, outcome


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"rf_train_eval", "rf_predict", "feature_importance"}))
def test_no_row_python_and_no_pair_joins(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("BatchEvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert unwanted not in plan
