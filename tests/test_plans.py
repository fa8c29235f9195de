"""What the physical plans must look like."""

import re

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from clickloom.operators import features, velocity
from clickloom.plans import queries as registry

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "name", ["session_funnel", "checkout_funnel", "cart_idle_sessions", "persona_distribution"]
)
def test_event_filters_reach_the_scan(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*(In|EqualTo)\(event_name", plan), plan


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["payment_friction"](spark, SF_DIR))
    assert "ReadSchema: struct<event_name:string,variant:string>" in plan
    nested = plan_of(QUERIES["persona_distribution"](spark, SF_DIR))
    assert "event_properties:struct<persona:string>" in nested


@pytest.mark.parametrize("operator", [features.churn_features, features.observation_cutoff])
def test_features_of_ordinary_sessions_need_one_shuffle_and_sort(no_broadcast, operator):
    events = registry._events(no_broadcast, SF_DIR)
    plan = executed(operator(events, []))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("FileScan parquet") == 1
    assert "Join" not in plan


def test_features_of_hot_sessions_fold_before_they_move(no_broadcast):
    events = registry._events(no_broadcast, SF_DIR)
    plan = executed(features.churn_features(events, ["1-1"]))
    # both branches over the folded rows come from one shuffle
    assert "ReusedExchange" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["intervention_portfolio", "top_opportunities", "top_roi"])
def test_top_k_is_distributed(spark, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize(
    "name",
    ["quality_report", "score_contract", "warehouse_contract", "executive_kpis",
     "threshold_sweep", "load_reconciliation", "purchase_consistency", "roc_auc"],
)
def test_reports_need_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_sessions_are_windowed_by_segment(no_broadcast):
    events = registry._events(no_broadcast, SF_DIR)
    for df in (
        velocity.event_context(events, ["1-1"]),
        features.ordered_events(events, ["1-1"]),
    ):
        rows = [
            line
            for line in plan_of(df).splitlines()
            if "Window [row_number" in line or "Window [lag(_here" in line
        ]
        assert rows and all("_segment" in line for line in rows)


def test_ordinary_sessions_need_one_shuffle(no_broadcast):
    plan = plan_of(velocity.event_context(registry._events(no_broadcast, SF_DIR), []))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window [") == 1
