"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from tidemark.plans.queries import QUERIES  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(KEYS) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["day", "n_orders", "n_lines", "units"]
    assert df.count() > 0


FORBIDDEN_PLAN_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                        "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    ok, msg = compare(df, con, E.oracle_sql()[key])
    assert ok, msg
    plan = _plan(df)
    assert not [n for n in FORBIDDEN_PLAN_NODES if n in plan], plan


def test_range_filter_is_pushed_to_parquet(spark):
    plan = E.queries()["updated_range_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan
