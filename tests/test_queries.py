"""Every query of the library against its SQL at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from sonorium.plans.registry import QUERIES, SQL
from tests.compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, name):
    assert compare(spark, QUERIES[name], SQL.get(name), SF).startswith(("same", "rows only"))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_reach_the_scan(spark):
    plan = QUERIES["year_prefix"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderkey" in plan and "o_totalprice" not in plan
    plan = QUERIES["available_minus_expected"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)" in plan
