"""Plan-shape guards for the scale properties the README claims."""

import pytest

from __spark_entry__ import queries
from hourcast.plans.catalog import REGISTRY as CATALOG

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_event_scan_is_pruned_and_pre_aggregated(spark):
    plan = plan_of(queries()["hourly_from_events"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan
    assert "partial_avg" in plan and "partial_count" in plan


def test_running_profile_averages_before_the_window_shuffle(spark):
    plan = plan_of(queries()["cumulative_profile"](spark, SF))
    exchanges = [i for i, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in line]
    below = plan.splitlines()[exchanges[1] + 1:]
    assert any("partial_avg(successful_charges" in line for line in below)
    # Events, hourly rows, profile rows: the window's exchange carries profile rows only.
    assert len(exchanges) == 3


def test_tree_scoring_joins_once(spark):
    plan = plan_of(queries()["tree_score_segments"](spark, SF))
    assert plan.count("Join") == 1 and "Union" not in plan


def test_linear_scoring_broadcasts_the_model_table(spark):
    plan = plan_of(queries()["linear_score_join"](spark, SF))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_union_of_segments_is_one_plan(spark):
    plan = plan_of(queries()["union_segments"](spark, SF))
    assert "Union" not in plan and plan.count("Join") == 1
