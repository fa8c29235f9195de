import datetime as dt
import random

import pytest
from conftest import at, make_events, rows
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.operators import contracts, features, reports

GOLDEN = [
    ("session_purchase", "u1", "10:00", "session_start"),
    ("session_purchase", "u1", "10:01", "homepage_view"),
    ("session_purchase", "u1", "10:02", "product_view"),
    ("session_purchase", "u1", "10:03", "add_to_cart"),
    ("session_purchase", "u1", "10:05", "purchase_complete"),
    ("session_purchase", "u1", "10:06", "session_end"),
    ("session_churn", "u2", "11:00", "session_start"),
    ("session_churn", "u2", "11:01", "homepage_view"),
    ("session_churn", "u2", "11:02", "product_view"),
    ("session_churn", "u2", "11:03", "add_to_cart"),
    ("session_churn", "u2", "11:05", "session_end"),
]
KEY = ("session_id", "purchased", "churned", "total_actions_so_far", "has_cart")


def test_golden(spark):
    got = features.churn_features(make_events(spark, GOLDEN))
    assert tuple(got.columns) == S.FEATURE_TABLE_COLUMNS
    assert rows(got, *KEY) == [("session_churn", 0, 1, 4, 1), ("session_purchase", 1, 0, 4, 1)]
    r = got.where("session_id = 'session_purchase'").first()
    assert r.observation_timestamp == at("10:03")
    assert r.observed_session_duration_minutes == 3.0 and r.unique_event_types == 4


def test_events_after_the_cutoff_change_only_the_label(spark):
    base = features.churn_features(make_events(spark, GOLDEN[6:]))
    later = GOLDEN[6:] + [
        ("session_churn", "u2", "11:04", "purchase_complete"),
        ("session_churn", "u2", "11:06", "payment_error"),
        ("session_churn", "u2", "11:07", "add_to_cart"),
    ]
    got = features.churn_features(make_events(spark, later))
    same = [c for c in S.FEATURE_TABLE_COLUMNS if c not in ("purchased", "churned")]
    assert rows(got, *same) == rows(base, *same)
    assert rows(got, "purchased", "churned") == [(1, 0)]


def test_purchase_first_has_no_features(spark):
    events = make_events(
        spark, [("s", "u", "10:00", "purchase_complete"), ("s", "u", "10:01", "search")]
    )
    assert rows(features.churn_features(events)) == []
    assert rows(features.session_outcomes(events)) == [("s", 1, at("10:00"))]


def test_event_at_the_purchase_time_is_not_observed(spark):
    events = make_events(
        spark,
        [
            ("s", "u", "10:00", "search"),
            ("s", "u", "10:01", "add_to_cart"),
            ("s", "u", "10:01", "purchase_complete"),
        ],
    )
    assert rows(features.churn_features(events), "total_actions_so_far", "has_cart") == [(1, 0)]


@pytest.mark.parametrize("hot", [[], ["s"]])
@pytest.mark.parametrize("purchase", [None, "10:01", "10:30"])
def test_session_end_counts_up_to_the_cutoff(spark, purchase, hot):
    data = [
        ("s", "u", "10:00", "search"),
        ("s", "u", "10:00", "session_end"),
        ("s", "u", "10:00:30", "session_end"),
    ]
    if purchase:
        data.append(("s", "u", purchase, "purchase_complete"))
    got = features.churn_features(make_events(spark, data), hot)
    assert rows(got, "total_actions_so_far", "unique_event_types") == [(2, 2)]


def test_only_the_cutoff_user_counts(spark):
    events = make_events(
        spark,
        [
            ("s", "a", "10:00", "add_to_cart"),
            ("s", "b", "10:01", "search", {"device_type": "desktop"}),
            ("s", "b", "10:02", "search", {"device_type": "tablet"}),
        ],
    )
    got = features.churn_features(events)
    assert rows(got, "user_id", "device_type", "total_actions_so_far", "has_cart") == [
        ("b", "tablet", 2, 0)
    ]


def brute_force(events):
    """Features by the definition, in plain Python: the slow, obvious way."""
    sessions = {}
    for e in events.collect():
        sessions.setdefault(e.session_id, []).append(e)
    out = []
    for session, es in sessions.items():
        bought = [e.event_timestamp for e in es if e.event_name == "purchase_complete"]
        seen = [
            e
            for e in es
            if e.event_name not in ("purchase_complete", "session_end")
            and (not bought or e.event_timestamp < min(bought))
        ]
        if not seen:
            continue
        last = max(
            seen, key=lambda e: (e.event_timestamp, e.user_id, e.device_type, e.traffic_source)
        )
        used = [
            e
            for e in es
            if e.event_timestamp <= last.event_timestamp and e.user_id == last.user_id
        ]
        times = [e.event_timestamp for e in used]
        out.append(
            (
                session,
                last.user_id,
                last.event_timestamp,
                last.device_type,
                int(bool(bought)),
                len(used),
                len({e.event_name for e in used}),
                sum(e.event_name == "payment_error" for e in used),
                int(any(e.event_name == "add_to_cart" for e in used)),
                min(times),
                max(times),
            )
        )
    return sorted(out, key=repr)


@pytest.mark.parametrize(
    "hot, seconds", [(None, 60), ([], 60), (["hot"], 5), (["hot"], 900), (["hot", "s1"], 10**9)]
)
def test_equals_brute_force_with_a_hot_session(spark, hot, seconds):
    rng = random.Random(11)
    names = [n for n in S.EVENT_NAMES if n != "purchase_complete"]
    data = []
    for i in range(1500):
        hot = i % 3 == 0
        session = "hot" if hot else f"s{rng.randrange(120)}"
        moment = at("08:00") + dt.timedelta(seconds=rng.randrange(9_000))
        late = hot and moment < at("09:30") or rng.random() < 0.9
        name = rng.choice(names) if late else "purchase_complete"
        extra = {"device_type": rng.choice(["mobile", "desktop"])}
        data.append((session, f"u{rng.randrange(2)}", moment, name, extra))
    events = make_events(spark, data)
    got = features.churn_features(events, hot, seconds).select(
        "session_id",
        "user_id",
        "observation_timestamp",
        "device_type",
        "purchased",
        "total_actions_so_far",
        "unique_event_types",
        "payment_errors",
        "has_cart",
        "session_start_timestamp",
        "latest_event_timestamp",
    )
    assert rows(got) == brute_force(events)


def test_observation_rows(spark):
    events = make_events(spark, GOLDEN)
    assert features.observation_events(events).count() == 8
    assert rows(features.observation_cutoff(events), "session_id", "observation_timestamp") == [
        ("session_churn", at("11:03")),
        ("session_purchase", at("10:03")),
    ]


def test_correlations(spark):
    data = spark.createDataFrame(
        [(1, 2, 5.0, 3), (2, 4, 5.0, 1), (3, 6, 5.0, 2)], "a long, b long, c double, d long"
    )
    columns = ("a", "b", "c", "d")
    got = {(r[0], r[1]): r[2] for r in features.feature_correlations(data, columns).collect()}
    assert len(got) == 16 and got["a", "b"] == pytest.approx(1.0)
    assert got["a", "d"] == got["d", "a"] == pytest.approx(-0.5)
    assert got["c", "c"] is None and got["a", "c"] is None  # constant column
    high = features.high_correlations(data, columns)
    assert rows(high, "feature_a", "feature_b") == [("a", "b")]


def test_reports_and_contract(spark):
    table = features.churn_features(make_events(spark, GOLDEN))
    assert rows(features.churn_summary(table)) == [(2, 2, 1, 1, 50.0)]
    assert rows(features.churn_distribution(table)) == [(0, 1, 50.0), (1, 1, 50.0)]
    assert rows(reports.churn_by(table, "device_type")) == [("mobile", 2, 50.0)]
    assert contracts.ml_integrity(table).first().passed
    assert contracts.ml_schema_contract(table).first().passed

    broken = table.unionByName(table.limit(1)).withColumn("churned", F.lit(7))
    report = contracts.ml_integrity(broken).first()
    assert report.duplicate_sessions == 1 and report.invalid_labels == 3 and not report.passed

    leaking = table.withColumn("purchase_timestamp", F.lit(1)).drop("has_cart")
    report = contracts.ml_schema_contract(leaking).first()
    assert report.forbidden_columns == 1 and report.missing_names == "has_cart"
    extra = contracts.ml_schema_contract(table.withColumn("churned_2", F.lit(1))).first()
    assert not extra.outcome_columns_exact
