"""Plans of the registered queries: no theta joins, scans pruned and filtered; and every query runs."""

from __future__ import annotations

import pytest

from lodeworks.plans import registry

#: Queries that cross join one-row aggregates.
ONE_ROW = {"agg06_global_median", "agg10_divergence", "agg31_distribution_pct", "agg34_totals_top_share"}
#: These run jobs while their plan is made; they are run by the comparison with SQL.
EAGER = {"er_fold_dedup", "stream01_window_counts", "stream02_first_of_key", "mod10_boosted"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - EAGER))
def test_no_theta_join(spark, sf, name):
    text = plan(registry.QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text
    if name not in ONE_ROW:
        assert "BroadcastNestedLoopJoin" not in text


def test_pushdown(spark, sf):
    text = plan(registry.QUERIES["prj07_filters"](spark, sf))
    assert "In(l_returnflag, [A,R])" in text and "EqualTo(l_linestatus,F)" in text
    assert "l_extendedprice" not in text
    text = plan(registry.QUERIES["agg06_global_median"](spark, sf))
    assert "EqualTo(o_orderstatus,F)" in text and "o_orderpriority" not in text


def test_oracles_name_queries():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES) and registry.FLAGSHIP in registry.QUERIES
