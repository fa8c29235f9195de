"""Rows that no fixture holds: missing keys, times and ids, large values,
batches of different fields, hot keys of every kind."""

import datetime as dt

import pytest
from conftest import at, make_events, rows
from pyspark.sql import functions as F

from clickloom.functions import segments
from clickloom.operators import features, modeling, velocity
from clickloom.sources import fixture, landing
from clickloom.sources.loading import load_events
from clickloom.sources.tables import Warehouse


# ------------------------------------------------------------------- hot keys
def odd_events(spark):
    """Equal times, missing ids, times and sessions in several sessions."""
    clock = ["10:00:00", "10:00:00", "10:00:30", "10:02:00", None, "10:02:00", None]
    out = []
    for session in ("s", "t", None):
        for i, time in enumerate(clock * 3):
            extra = {"event_id": None} if i % 4 == 1 else {}
            name = ("homepage_view", "search", "product_view", None)[i % 4]
            out.append((session, "u", at(time) if time else None, name, extra))
    return make_events(spark, out)


HOT_LISTS = ([], ["s"], ["s", None], ["s", "t", None], [None])




@pytest.mark.parametrize("seconds", [1, 60, 86_400])
def test_hot_lists_never_change_positions(spark, seconds):
    events = odd_events(spark)
    seen = []
    for hot in HOT_LISTS:
        placed = segments.with_positions(
            events, "session_id", "event_timestamp", "event_id", "place", "total", hot, seconds
        )
        # ties in every respect may swap, so compare what stands at each place
        seen.append(rows(placed, "session_id", "place", "total", "event_timestamp", "event_id"))
    assert all(s == seen[0] for s in seen)
    assert {r[2] for r in seen[0]} == {21}


@pytest.mark.parametrize("seconds", [1, 60, 86_400])
def test_hot_lists_never_change_neighbours(spark, seconds):
    events = odd_events(spark)
    carry = ["event_timestamp", "event_id"]
    seen = []
    for hot in HOT_LISTS:
        near = segments.with_neighbours(
            events, "session_id", "event_timestamp", "event_id", carry, hot, seconds
        )
        seen.append(rows(near, "session_id", "event_timestamp", "event_id", "previous", "following"))
    assert all(s == seen[0] for s in seen)


def test_missing_id_comes_last_among_equal_times(spark):
    clock = "10:00:00"
    events = make_events(
        spark,
        [
            ("s", "u", clock, "homepage_view"),
            ("s", "u", clock, "search", {"event_id": None}),
            ("s", "u", "10:05:00", "product_view"),
        ],
    )
    for hot in ([], ["s"]):
        found = velocity.event_context(events, hot).where("event_name = 'product_view'").first()
        assert found["previous_event_name"] == "search"


def test_hot_keys_find_missing_sessions_and_large_keys(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") < 3000, None).when(F.col("id") < 3040, "big").otherwise(F.col("id").cast("string")).alias("k")
    )
    assert segments.hot_keys(df, "k") == [None, "big"]
    # by rows a task instead of by share
    assert set(segments.hot_keys(df, "k", share=2, task_rows=30)) >= {None, "big"}


# ------------------------------------------------------------------- features
def test_events_without_time_are_no_observation(spark):
    events = make_events(
        spark,
        [
            ("s", "u", "10:00:00", "session_start"),
            ("s", "u", "10:01:00", "product_view"),
            ("s", "u", None, "product_view"),
        ],
    )
    for hot in ([], ["s"]):
        found = features.churn_features(events, hot).first()
        assert (found.total_actions_so_far, found.product_views) == (2, 1)


def test_no_user_id_is_special(spark):
    events = make_events(
        spark,
        [
            ("a", "<no user>", "10:00:00", "product_view"),
            ("b", "", "10:00:00", "product_view"),
            ("c", None, "10:00:00", "product_view"),
        ],
    )
    found = features.churn_features(events, [])
    assert rows(found, "session_id", "user_id") == [("a", "<no user>"), ("b", "")]
    cutoff = features.observation_cutoff(events, [])
    assert rows(cutoff, "session_id", "user_id") == [("a", "<no user>"), ("b", ""), ("c", None)]


def test_correlations_of_large_constant_and_missing_values(spark):
    data = [(1e9 + i, float(i % 7), 5.0, None if i % 3 == 0 else float(-i)) for i in range(60)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double")
    columns = ("a", "b", "c", "d")
    got = {(r[0], r[1]): r[2] for r in rows(features.feature_correlations(df, columns))}
    assert len(got) == 16
    for x in columns:
        for y in columns:
            if "c" in (x, y):
                assert got[x, y] is None
                continue
            want = df.select(F.corr(x, y)).first()[0]
            assert got[x, y] == pytest.approx(want, abs=1e-9)
    assert got["a", "a"] == pytest.approx(1.0) and got["a", "d"] == pytest.approx(-1.0)
    high = features.high_correlations(df, columns, 0.8)
    assert rows(high, "feature_a", "feature_b") == [("a", "d")]


# -------------------------------------------------------------------- landing
def two_batches(spark, folder, first, second):
    parts = {
        "few": "SELECT 'e1' AS event_id, 'u' AS user_id, 's' AS session_id, "
        "'2026-01-01 10:00:00' AS event_timestamp, 'search' AS event_name, 'control' AS variant, "
        "'EXP-001' AS experiment_id, "
        "named_struct('query', 'q') AS event_properties",
        "many": "SELECT 'e2' AS event_id, 'u' AS user_id, 's' AS session_id, "
        "TIMESTAMP '2026-01-01 10:01:00' AS event_timestamp, 'cart_view' AS event_name, 'control' AS variant, "
        "'EXP-001' AS experiment_id, "
        "'mobile' AS device_type, named_struct('idle_before_cart_view_seconds', 90L) AS event_properties",
    }
    for number, kind in ((1, first), (2, second)):
        landing.write_batch(spark.sql(parts[kind]), number, folder)
    return landing.landing_glob(folder)


@pytest.mark.parametrize("order", [("few", "many"), ("many", "few")])
def test_batches_of_different_fields_and_types(spark, folder, order):
    events = landing.read_events(spark, two_batches(spark, folder, *order))
    got = {r.event_id: r for r in events.collect()}
    assert got["e1"].event_properties.query == "q" and got["e1"].device_type is None
    assert got["e2"].event_properties.idle_before_cart_view_seconds == 90
    assert got["e2"].device_type == "mobile"
    assert got["e1"].event_timestamp.replace(tzinfo=None) == dt.datetime(2026, 1, 1, 10)


def test_rejected_load_keeps_the_table_and_readers_see_what_was_checked(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    load_events(warehouse, two_batches(spark, f"{folder}/good", "few", "many"))
    bad = make_events(spark, [(None, "u", "10:00:00", "search")])
    landing.write_batch(bad, 1, f"{folder}/bad")
    with pytest.raises(ValueError):
        load_events(warehouse, landing.landing_glob(f"{folder}/bad"))
    assert rows(warehouse.read("events"), "event_id") == [("e1",), ("e2",)]


def test_adapter_keeps_events_without_user_or_time(spark):
    raw = spark.createDataFrame(
        [
            (1, dt.datetime(2026, 1, 1, 10), 7, "view", 1.0, '{"k": 2}'),
            (2, None, 7, "click", 1.0, '{"k": 2}'),
            (3, dt.datetime(2026, 1, 1, 10), None, "view", 1.0, '{"k": 3}'),
        ],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    )
    events = fixture.canonical_events(raw).where(~F.col("event_name").isin("session_start", "session_end"))
    assert rows(events, "event_id", "session_id") == [("1", "7-1"), ("2", None), ("3", None)]


# --------------------------------------------------------------------- models
def test_split_holds_the_share_of_each_label(spark):
    table = spark.range(4000).select(
        F.concat(F.lit("s"), "id").alias("session_id"), (F.col("id") % 10 == 0).cast("int").alias("churned")
    )
    train, test = modeling.split(table)
    assert train.count() + test.count() == 4000
    counts = dict(rows(test.groupBy("churned").count()))
    assert abs(counts[0] - 720) <= 3 and abs(counts[1] - 80) <= 3
    assert rows(modeling.split(table)[1]) == rows(test)


# ---------------------------------------------------------- ranks and portfolio
def test_crowded_scores_spread_over_buckets(spark):
    from clickloom.functions import ladder

    df = spark.range(50_000).select(
        (0.75 + F.col("id") * 4e-8).alias("p"), (F.col("id") % 3 == 0).cast("int").alias("y")
    )
    steps = ladder._with_bucket(df.select(F.col("p").alias("score")).distinct())
    most = steps.groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert most <= 50_000 / ladder.BUCKETS * 3
    ranks = ladder.score_ladder(df, "p", "y")
    assert ranks.where((F.col("n_below") != F.round((F.col("score") - 0.75) / 4e-8)) | (F.col("n") != 1)).isEmpty()


def test_portfolio_of_any_capacity(spark, monkeypatch):
    from clickloom import schema as S
    from clickloom.operators import interventions

    action = S.RECOVERY_ACTIONS[0]
    base = spark.range(3000).select(
        F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("session_id"),
        F.lit(action).alias("recommended_action"),
        (F.col("id") % 7).alias("business_priority_score"),
        (F.col("id") % 11).cast("double").alias("expected_net_value"),
        (F.col("id") % 5).cast("double").alias("churn_risk_score"),
    )
    missing = [c for c in interventions.ECONOMICS_COLUMNS if c not in base.columns]
    table = base.select("*", *[F.lit(1.0).alias(c) for c in missing])
    want = rows(interventions.intervention_portfolio(table, 2000), "portfolio_rank", "session_id")
    monkeypatch.setattr(interventions, "IN_ONE_TASK", 10)
    got = interventions.intervention_portfolio(table.repartition(9), 2000)
    assert rows(got, "portfolio_rank", "session_id") == want


# ------------------------------------------------------------------- streaming
def test_stream_gate_refuses_ids_of_earlier_batches(spark, folder):
    from clickloom.streaming import incremental

    for number in (1, 2):
        data = [("s", "u", "10:00:00", "search"), ("s", "u", "10:01:00", "search")][: 3 - number]
        landing.write_batch(make_events(spark, data), number, f"{folder}/in")
        stream = incremental.landing_stream(spark, landing.landing_glob(f"{folder}/in"))
        incremental.gated_load(
            stream, f"{folder}/ok", f"{folder}/bad", f"{folder}/reports", f"{folder}/cp"
        ).awaitTermination(120)
    assert rows(spark.read.parquet(f"{folder}/ok"), "event_id", "batch") == [("e00000", 0), ("e00001", 0)]
    assert rows(spark.read.parquet(f"{folder}/bad"), "event_id", "batch") == [("e00000", 1)]


def test_stream_funnel_keeps_a_session_in_one_row(spark, folder):
    from clickloom.streaming import incremental

    session = [
        ("s", "u", "10:00:00", "homepage_view"),
        ("s", "v", "10:20:00", "product_view"),
        ("s", "u", "10:40:00", "product_view"),
        ("s", "u", "11:00:00", "purchase_complete"),
    ]
    later = [("late", "u9", "18:00:00", "homepage_view")]
    for number, batch in enumerate((session, later, later), start=1):
        landing.write_batch(make_events(spark, batch), number, f"{folder}/in")
        stream = incremental.landing_stream(spark, landing.landing_glob(f"{folder}/in"))
        incremental.append_events(
            incremental.rolling_funnel(stream), f"{folder}/out", f"{folder}/cp"
        ).awaitTermination(120)
    got = spark.read.parquet(f"{folder}/out")
    assert rows(got, "session_id", "user_id", "funnel_outcome") == [("s", "u", "purchased")]


# ------------------------------------------------------------------- contracts
@pytest.mark.parametrize("name, nonzero", [
    ("damaged_score_contract", ["duplicate_sessions", "feature_sessions_missing_scores",
     "unexpected_scored_sessions", "missing_scores", "out_of_range_scores", "invalid_risk_bands"]),
    ("damaged_candidate_contract", ["duplicate_sessions", "missing_interventions",
     "unexpected_interventions", "invalid_actions", "invalid_priorities"]),
])
def test_contracts_find_damage(spark, name, nonzero):
    from clickloom.plans import queries as registry

    found = registry.queries()[name](spark, "/root/testdata/sf0.01").first().asDict()
    assert found["passed"] is False and all(found[c] > 0 for c in nonzero)


# --------------------------------------------------------------------- storage
def test_periods_open_only_their_days(spark, folder):
    warehouse = Warehouse(spark, folder)
    data = [(f"s{d}", "u", at("10:00:00", d), "search") for d in range(1, 9)] + [("n", "u", None, "search")]
    events = make_events(spark, data)
    warehouse.write("events", events, F.to_date("event_timestamp"))
    assert warehouse.read("events").columns == events.columns
    assert rows(warehouse.read("events"), "event_id") == rows(events, "event_id")
    period = warehouse.read_days("events", dt.date(2026, 1, 3), dt.date(2026, 1, 4))
    assert rows(period, "session_id") == [("s3",), ("s4",)]
    plan = period._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan
    assert len(period.inputFiles()) <= len(warehouse.read("events").inputFiles())


def test_two_writers_lose_no_version(spark, folder):
    one, two = Warehouse(spark, folder), Warehouse(spark, folder)
    first = one.stage("t", spark.range(1).toDF("a"))
    second = two.stage("t", spark.range(2).toDF("a"))
    two.publish("t", second)
    one.publish("t", first)  # publishes last
    assert one.versions("t") == two.versions("t") == [first, second]
    assert two.read("t").count() == 1
    assert one.remove_old_versions("t") == [second]
    assert two.read("t").count() == 1
    with pytest.raises(FileNotFoundError):
        one.read("other")
