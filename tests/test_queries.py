"""Every registered query against its DuckDB counterpart on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from attestry.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() >= 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert costly not in plan


def test_every_query_has_a_counterpart():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["evidence_counts"](spark, FOLDER)._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "event_type" in line]
    assert scans
    for line in scans:
        assert "PushedFilters: [IsNotNull(event_type)" in line or "PushedFilters: [IsNotNull(value)" in line or "EqualTo(event_type" in line
        assert "props" not in line
