import datetime as dt
import random

import pytest
from conftest import at, make_events, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.functions.segments import hot_keys, with_neighbours, with_positions
from clickloom.operators import funnel, velocity

STEPS = [
    ("s1", "u1", "10:00", "homepage_view"),
    ("s1", "u1", "10:01", "product_click"),
    ("s1", "u1", "10:02", "add_to_cart"),
    ("s1", "u1", "10:05", "purchase_complete"),
    ("s2", "u2", "11:00", "homepage_view"),
    ("s2", "u2", "11:02", "product_click"),
    ("s2", "u2", "11:09", "search"),
    ("s3", "u3", "12:00", "search"),
]


def test_session_funnel(spark):
    got = funnel.session_funnel(make_events(spark, STEPS))
    assert rows(got, "session_id", "user_id", "funnel_outcome") == [
        ("s1", "u1", "purchased"),
        ("s2", "u2", "product_abandoned"),
    ]
    s1 = got.where("session_id = 's1'").first()
    assert s1.purchase_complete_at == at("10:05") and s1.reached_cart


def test_outcome_ignores_step_order(spark):
    events = make_events(
        spark, [("s", "u", "10:00", "purchase_complete"), ("s", "u", "10:01", "homepage_view")]
    )
    session = funnel.session_funnel(events)
    assert session.first().funnel_outcome == "purchased"
    assert rows(funnel.funnel_ordering(session)) == [(0, 0, 0)]


def test_shared_session_belongs_to_first_owner_of_each_step(spark):
    events = make_events(
        spark,
        [
            ("s", "a", "10:00", "homepage_view"),
            ("s", "b", "10:01", "homepage_view"),
            ("s", "b", "10:02", "add_to_cart"),
        ],
    )
    got = funnel.session_funnel(events)
    assert rows(got, "user_id", "reached_homepage", "reached_cart", "funnel_outcome") == [
        ("a", True, False, "homepage_abandoned"),
        ("b", False, True, "cart_abandoned"),
    ]


def test_equal_times_are_decided_by_event_id(spark):
    tie = [
        ("s", "b", "10:00", "homepage_view", {"event_id": "2"}),
        ("s", "a", "10:00", "homepage_view", {"event_id": "1"}),
    ]
    assert rows(funnel.first_step_events(make_events(spark, tie)), "user_id") == [("a",)]


def test_funnel_metrics(spark):
    got = funnel.funnel_metrics(funnel.session_funnel(make_events(spark, STEPS)))
    assert [tuple(r) for r in got.collect()] == [
        (1, "homepage_view", 2, 100.0, None, 0, 0.0),
        (2, "product_click", 2, 100.0, 100.0, 0, 0.0),
        (3, "add_to_cart", 1, 50.0, 50.0, 1, 50.0),
        (4, "purchase_complete", 1, 50.0, 100.0, 0, 0.0),
    ]


def test_funnel_metrics_without_entries(spark):
    only_cart = make_events(spark, [("s", "u", "10:00", "add_to_cart")])
    got = funnel.funnel_metrics(funnel.session_funnel(only_cart)).collect()
    assert [r.absolute_conversion_pct for r in got] == [None] * 4
    assert got[2].step_dropoff_sessions == -1 and got[2].step_dropoff_pct is None


def test_checkout_funnel_counts_sessions(spark):
    events = make_events(
        spark,
        [
            ("s1", "u", "10:00", "product_view"),
            ("s1", "u", "10:01", "product_view"),
            ("s2", "u", "10:00", "product_view"),
            ("s2", "u", "10:01", "add_to_cart"),
        ],
    )
    got = [tuple(r)[1:] for r in funnel.checkout_funnel(events).collect()]
    assert got == [
        ("product_view", 2, 100.0),
        ("add_to_cart", 1, 50.0),
        ("checkout_start", 0, 0.0),
        ("purchase_complete", 0, 0.0),
    ]


# --------------------------------------------------------------------- velocity
def test_velocity_rounds_each_gap_first(spark):
    events = make_events(
        spark,
        [
            ("s", "u", at("10:00"), "search"),
            ("s", "u", at("10:00") + dt.timedelta(seconds=0.4), "search"),
            ("s", "u", at("10:00") + dt.timedelta(seconds=0.8), "search"),
            ("one", "u", at("10:00"), "search"),
        ],
    )
    got = {r.session_id: r for r in velocity.velocity_metrics(events).collect()}
    # 0.4 s are 0.00667 minutes, 0.01 when rounded
    assert got["s"].average_event_gap_minutes == 0.01
    assert got["s"].session_duration_minutes == 0.01 and got["s"].total_events == 3
    single = got["one"]
    assert single.total_events == 1 and single.session_duration_minutes == 0.0
    assert single.average_event_gap_minutes is None
    assert single.maximum_event_gap_minutes is None


def test_time_differences_ignore_the_session_zone(spark):
    """02:30 does not exist in New York on 2026-03-08; plain timestamps do not care."""
    day = dt.datetime(2026, 3, 8)
    events = make_events(
        spark,
        [
            ("s", "u", day.replace(hour=1, minute=30), "search"),
            ("s", "u", day.replace(hour=2, minute=30), "search"),
            ("s", "u", day.replace(hour=3, minute=30), "search"),
        ],
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = velocity.velocity_metrics(events).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got.session_duration_minutes == 120.0
    assert got.average_event_gap_minutes == 60.0 and got.maximum_event_gap_minutes == 60.0


def test_cart_idle_weights_repeated_starts(spark):
    def props(persona=None, idle=None):
        return {"event_properties": (persona, None, idle)}

    events = make_events(
        spark,
        [
            ("s1", "u1", "10:00", "session_start", props("p")),
            ("s1", "u1", "10:01", "session_start", props("p")),
            ("s1", "u1", "10:02", "cart_view", props(idle=10)),
            ("s2", "u2", "10:00", "session_start", props("p")),
            ("s2", "u2", "10:01", "cart_view", props(idle=40)),
            ("s2", "u2", "10:02", "cart_view", props()),
            ("s3", "u3", "10:00", "session_start", props("q")),
        ],
    )
    # joined pairs: 10, 10, 40
    assert rows(velocity.cart_idle_events(events)) == [("p", 3, 20.0, 40.0)]
    assert rows(velocity.cart_idle_sessions(events)) == [("p", 25.0, 40.0)]
    assert rows(velocity.persona_distribution(events)) == [("p", 2, 3), ("q", 1, 1)]


def test_payment_friction_without_attempts(spark):
    events = make_events(spark, [("s", "u", "10:00", "payment_error")])
    assert rows(velocity.payment_friction(events)) == [("control", 0, 1, None)]


# ----------------------------------------------- segments against plain windows
@pytest.fixture(scope="module")
def skewed(spark):
    """One session with a third of all rows, ties included."""
    rng = random.Random(7)
    out = []
    for i in range(900):
        session = "hot" if i % 3 == 0 else f"s{rng.randrange(60)}"
        moment = at("08:00") + dt.timedelta(seconds=rng.randrange(20_000))
        out.append((session, f"u{rng.randrange(3)}", moment, rng.choice(["search", "cart_view"])))
    return make_events(spark, out).cache()


SPLITS = [
    (None, 60),  # hot keys as found
    ([], 60),  # nothing split
    (["hot"], 1),
    (["hot", "s1", "absent"], 900),
    (["hot"], 10**9),
]


def test_hot_keys(spark, skewed):
    assert hot_keys(skewed, "session_id", share=10) == ["hot"]
    assert "hot" in hot_keys(skewed, "session_id")
    assert hot_keys(skewed.limit(0), "session_id") == []
    assert len(hot_keys(spark.range(5000).selectExpr("CAST(id AS STRING) AS k"), "k")) == 0


@pytest.mark.parametrize("hot, seconds", SPLITS)
def test_neighbours_equal_a_plain_window(skewed, hot, seconds):
    w = Window.partitionBy("session_id").orderBy("event_timestamp", "event_id")
    plain = skewed.select(
        "event_id", F.lag("event_id").over(w).alias("p"), F.lead("event_id").over(w).alias("f")
    )
    got = with_neighbours(
        skewed, "session_id", "event_timestamp", "event_id", ["event_id"], hot, seconds
    ).select("event_id", F.col("previous.event_id"), F.col("following.event_id"))
    assert rows(got) == rows(plain)


@pytest.mark.parametrize("hot, seconds", SPLITS)
def test_positions_equal_a_plain_window(skewed, hot, seconds):
    w = Window.partitionBy("session_id")
    plain = skewed.select(
        "event_id",
        F.row_number().over(w.orderBy("event_timestamp", "event_id")),
        F.count("*").over(w),
    )
    got = with_positions(
        skewed, "session_id", "event_timestamp", "event_id", "pos", "n", hot, seconds
    ).select("event_id", "pos", "n")
    assert rows(got) == rows(plain)


def test_velocity_does_not_depend_on_segments_or_partitions(skewed):
    base = rows(velocity.velocity_metrics(skewed))
    assert rows(velocity.velocity_metrics(skewed, [])) == base
    assert rows(velocity.velocity_metrics(skewed, ["hot"], 7)) == base
    assert rows(velocity.velocity_metrics(skewed.repartition(13, "event_name"))) == base
