"""Shuffle and scan counts of the final adaptive plans (scale guards)."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from tools.plan_summary import summarise


def _shape(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()
    return summarise(df)


@pytest.mark.parametrize("name", ["top_gainers", "heatmap_tiers", "kpi_summary",
                                  "top5_context", "context_json"])
def test_series_a_queries_scan_lineitem_once(spark, name):
    """The performance frame is written once; what reads it (the latest time,
    the movers, the volatility) neither scans lineitem nor runs its windows."""
    from tidemark.plans.catalog import perf_a

    df = E.queries()[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and plan.count("lag(") == 0
    ranks = {"top_gainers": 1, "heatmap_tiers": 0, "kpi_summary": 0, "top5_context": 3, "context_json": 3}[name]
    final = plan[: plan.find("== Initial Plan ==")]
    assert final.count("Window [") <= ranks
    perf = perf_a(spark, SF_SMALL)
    perf.collect()
    s = summarise(perf)
    # partial -> final aggregate on (supplier, month), then the entity exchange
    assert s["hash"] == 2 and s["scan_cols"] == "3"


def test_top_lists_are_take_ordered(spark):
    assert _shape(spark, "top_gainers")["topk"] == 1
    assert _shape(spark, "top5_context")["topk"] == 3


def test_history_plus_forecast_reads_events_once(spark):
    df = E.queries()["history_plus_forecast"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan  # the written training series, not events again


def test_entity_history_pushes_its_filter(spark):
    s = _shape(spark, "entity_history")
    assert s["hash"] == 1 and s["pushed"] == "2"
