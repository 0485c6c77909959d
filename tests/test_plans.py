"""Plan shapes the scale design relies on (checked on the physical plan, so a regression shows up here)."""

from __future__ import annotations

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_per_page_work_is_narrow(spark):
    queries = entry.queries()
    for name in ("extract_articles", "html_to_text", "strip_fences", "response_status", "image_base64"):
        plan = _plan(queries[name](spark, SF))
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan, name


def test_requests_plan_no_join(spark):
    plan = _plan(entry.queries()["build_requests"](spark, SF))
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_cost_aggregates_before_joining_prices(spark):
    costs = entry.queries()["cost_by_model"](spark, SF)
    plan = _plan(costs)
    assert "partial_sum" in plan
    # the join sits above the aggregate: prices meet one row per model
    assert plan.index("Join") < plan.index("HashAggregate")
    # no broadcast is forced; at run time AQE measures the price list and broadcasts it
    costs.collect()
    final = _plan(costs).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final


def test_missing_scans_pre_aggregates_keys_and_prunes_columns(spark):
    plan = _plan(entry.queries()["missing_scans"](spark, SF))
    assert "LeftAnti" in plan
    assert "HashAggregate" in plan
    assert "ReadSchema: struct<page_id:bigint>" in plan  # the page html is never read


def test_first_success_combines_map_side(spark):
    plan = _plan(entry.queries()["first_success"](spark, SF))
    assert "partial_min" in plan or "partial_min_by" in plan
