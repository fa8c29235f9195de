"""The session layout: no shuffle of event rows, same results."""

import re

import pytest
from conftest import SF_DIR, at, make_events, rows
from pyspark.sql import functions as F

from clickloom.functions.segments import EVERY_KEY
from clickloom.operators import features, funnel, velocity
from clickloom.plans import queries as registry
from clickloom.sources.sessions import write_layout

OPERATORS = {
    "session_funnel": lambda events, hot, seconds: funnel.session_funnel(events),
    "velocity_metrics": velocity.velocity_metrics,
    "churn_features": features.churn_features,
    "ordered_events": features.ordered_events,
    "session_outcomes": lambda events, hot, seconds: features.session_outcomes(events),
}


@pytest.fixture(scope="module")
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", OPERATORS)
def test_ordinary_sessions_need_no_exchange(no_broadcast, folder, name):
    events = registry._events(no_broadcast, SF_DIR)
    layout = write_layout(events, f"{folder}/layout", hot=[], buckets=4)
    got = layout.per_session(no_broadcast, OPERATORS[name])
    plan = executed(got)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert rows(got) == rows(OPERATORS[name](events, [], 60))


@pytest.mark.parametrize("name", OPERATORS)
def test_hot_sessions_are_windowed_where_they_lie(no_broadcast, folder, name):
    events = registry._events(no_broadcast, SF_DIR)
    hot = [r[0] for r in events.groupBy("session_id").count().orderBy("session_id").limit(5).collect()]
    layout = write_layout(events, f"{folder}/layout", hot=hot, seconds=3600, buckets=4)
    got = layout.per_session(no_broadcast, OPERATORS[name])
    assert rows(got) == rows(OPERATORS[name](events, [], 60))
    ordinary, split = layout.ordinary(no_broadcast), layout.hot(no_broadcast)
    assert rows(split, "session_id")[0][0] in hot and ordinary.where(F.col("session_id").isin(hot)).count() == 0
    plan = executed(OPERATORS[name](split, EVERY_KEY, layout.seconds))
    # what a window or a first aggregate reads was not moved
    for window in re.finditer(r"Window \[(lag\(_here|row_number|min\(CASE)[^\n]*\n((?:[^\n]*\n){1,4})", plan):
        assert "Exchange" not in window[2], plan


def test_rows_are_kept_as_they_are(spark, folder):
    data = [("s1", "u", "10:00:00", "search"), (None, "u", "10:00:00", "search"), ("s2", None, "10:01:00", None)]
    data += [("hot", "u", at("10:00:00"), "search", {"event_id": None}), ("hot", "u", None, "purchase_complete")]
    events = make_events(spark, data * 3)
    for i, hot in enumerate([[], ["hot"], ["hot", None], None]):
        layout = write_layout(events, f"{folder}/{i}", hot=hot, buckets=2)
        assert layout.events(spark).columns == events.columns
        assert rows(layout.events(spark)) == rows(events)
        got = layout.per_session(spark, velocity.velocity_metrics)
        assert rows(got) == rows(velocity.velocity_metrics(events, []))
    none = write_layout(events.where("false"), f"{folder}/none")
    assert none.per_session(spark, velocity.velocity_metrics).count() == 0


def test_many_hot_keys_are_joined(spark, folder, monkeypatch):
    monkeypatch.setattr("clickloom.sources.sessions.MANY_KEYS", 3)
    events = registry._events(spark, SF_DIR)
    hot = [r[0] for r in events.select("session_id").distinct().orderBy("session_id").limit(40).collect()]
    layout = write_layout(events, f"{folder}/layout", hot=hot, buckets=2)
    assert layout.hot(spark).select("session_id").distinct().count() == 40
    assert layout.events(spark).count() == events.count()


def test_one_file_a_bucket_and_hot_sessions_spread(spark, folder):
    data = [("bot", "u", at("10:00:00"), "search", {"event_id": f"b{i}"}) for i in range(50)]
    data += [("bot", "u", f"{10 + i % 8}:{i % 60:02d}:00", "search", {"event_id": f"c{i}"}) for i in range(900)]
    data += [(f"s{i}", "u", "10:00:00", "search") for i in range(50)]
    layout = write_layout(make_events(spark, data), f"{folder}/layout", bucket_rows=100)
    assert (layout.buckets, layout.hot_buckets) == (1, 16)
    files = [int(re.search(r"_(\d{5})\.c000", f)[1]) for f in layout.hot(spark).inputFiles()]
    assert len(files) == len(set(files)) and len(files) > 8
