import pytest
from conftest import SF_DIR, make_events, rows
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.operators import contracts, funnel
from clickloom.plans import stages
from clickloom.sources import landing
from clickloom.sources.fixture import read_canonical, sessions_by_gap
from clickloom.sources.tables import Warehouse
from clickloom.streaming import incremental


# ------------------------------------------------------------------ test adapter
def test_adapter_golden_numbers(spark):
    events = read_canonical(spark, SF_DIR)
    assert events.schema.simpleString() == S.EVENT_SCHEMA.simpleString()
    got = events.agg(
        F.count("*"),
        F.count_distinct("event_id"),
        F.count_distinct("session_id"),
        F.count_distinct("user_id"),
    ).first()
    assert tuple(got) == (1658, 1658, 329, 15)
    reached = funnel.funnel_metrics(funnel.session_funnel(events)).collect()
    assert [r.sessions for r in reached] == [81, 84, 73, 148]


@pytest.mark.parametrize("slot", [600, 3600, 43_200])
def test_sessions_do_not_depend_on_the_slot(spark, slot):
    raw = spark.read.parquet(f"{SF_DIR}/events.parquet")
    per_user = sessions_by_gap(raw, slot_seconds=slot).groupBy("user_id").agg(F.max("session_no"))
    assert rows(per_user) == rows(
        sessions_by_gap(raw, slot_seconds=1800).groupBy("user_id").agg(F.max("session_no"))
    )


def test_slot_longer_than_the_gap_is_rejected(spark):
    with pytest.raises(ValueError):
        sessions_by_gap(spark.range(1), gap_seconds=10, slot_seconds=11)


# ------------------------------------------------------------------------ stages
def test_whole_run(spark, folder):
    landing.write_batch(read_canonical(spark, SF_DIR), 1, f"{folder}/landing")
    run = stages.Run(
        Warehouse(spark, f"{folder}/wh"),
        [landing.landing_glob(f"{folder}/landing")],
        f"{folder}/model",
        capacity=20,
        boosting_rounds=3,
        inference_unit="session",
    )
    done = stages.run_stages(run)
    assert done == [name for name, _ in stages.STAGES] and len(done) == 11
    assert run.results["quality"].first().is_valid
    assert run.results["experiment"].recommendation.endswith("Continue experiment.")
    report = stages.check_warehouse(run).first()
    assert report.passed and report.features_sessions == 329
    assert report.portfolio_sessions <= 20

    # a second run replaces every table and changes no counts
    stages.run_stages(run, stages.STAGES[:5])
    assert run.table("analytics_churn_feature_dataset").count() == 329


def test_failing_stage_stops_the_run(spark, folder):
    seen = []

    def broken(run):
        raise ValueError("broken")

    plan = [("a", lambda run: seen.append("a")), ("b", broken),
            ("c", lambda run: seen.append("c"))]
    with pytest.raises(RuntimeError, match="stage failed: b"):
        stages.run_stages(None, plan)
    assert seen == ["a"]
    run = stages.Run(Warehouse(spark, folder), [f"{folder}/none"], f"{folder}/model")
    with pytest.raises(RuntimeError, match="stage failed: load"):
        stages.run_stages(run)
    with pytest.raises(ValueError, match="missing tables"):
        stages.check_warehouse(run)


def test_scoring_without_a_model_fails(spark, folder):
    run = stages.Run(Warehouse(spark, folder), [], f"{folder}/model")
    with pytest.raises(FileNotFoundError):
        stages.risk_scores(run)
    for name in S.WAREHOUSE_TABLES:
        run.publish(name, spark.range(1))
    with pytest.raises(contracts.ContractError, match="model"):
        stages.check_warehouse(run)


# --------------------------------------------------------------------- streaming
FIRST = [
    ("s1", "u1", "10:00", "homepage_view"),
    ("s1", "u1", "10:02", "purchase_complete"),
    ("s2", "u2", "10:05", "homepage_view"),
]


def test_stream_drops_repeated_ids(spark, folder):
    events = make_events(spark, FIRST)
    landing.write_batch(events, 1, f"{folder}/in")
    landing.write_batch(events.limit(2), 2, f"{folder}/in")

    def load():
        stream = incremental.landing_stream(spark, landing.landing_glob(f"{folder}/in"))
        query = incremental.append_events(
            incremental.deduplicated(stream), f"{folder}/out", f"{folder}/cp"
        )
        query.awaitTermination(120)
        return spark.read.parquet(f"{folder}/out").count()

    assert load() == 3
    landing.write_batch(make_events(spark, [("s9", "u9", "10:06", "search", {"event_id": "new"})]),
                        3, f"{folder}/in")
    assert load() == 4  # only what landed since


def test_stream_gate_quarantines(spark, folder):
    data = FIRST + [
        ("s3", "u3", "10:00", "nope"),
        ("s3", "u3", "10:00", "search", {"event_id": "dup"}),
        ("s3", "u3", "10:01", "search", {"event_id": "dup"}),
        ("s3", None, "10:00", "search"),
    ]
    landing.write_batch(make_events(spark, data), 1, f"{folder}/in")
    stream = incremental.landing_stream(spark, landing.landing_glob(f"{folder}/in"))
    incremental.gated_load(
        stream, f"{folder}/ok", f"{folder}/bad", f"{folder}/reports", f"{folder}/cp"
    ).awaitTermination(120)
    assert spark.read.parquet(f"{folder}/ok").count() == 3
    assert spark.read.parquet(f"{folder}/bad").count() == 4
    report = spark.read.parquet(f"{folder}/reports").first()
    assert report.duplicate_event_ids == 1 and report.invalid_event_names == 1


def test_stream_funnel_equals_batch_for_closed_sessions(spark, folder):
    later = [("late", "u9", "18:00", "homepage_view")]  # moves the watermark
    for number, batch in enumerate((FIRST, later, later), start=1):
        landing.write_batch(make_events(spark, batch), number, f"{folder}/in")
        stream = incremental.landing_stream(spark, landing.landing_glob(f"{folder}/in"))
        query = incremental.append_events(
            incremental.rolling_funnel(stream), f"{folder}/out", f"{folder}/cp"
        )
        query.awaitTermination(120)
    got = spark.read.parquet(f"{folder}/out")
    want = funnel.session_funnel(make_events(spark, FIRST))
    assert rows(got, *want.columns) == rows(want)
