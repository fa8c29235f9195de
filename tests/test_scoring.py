import math
import random

import pytest
from conftest import rows

from clickloom import schema as S
from clickloom.operators import diagnostics as D
from clickloom.operators import reports, risk


def scored(spark, pairs):
    return spark.createDataFrame(
        [(f"s{i}", y, p) for i, (y, p) in enumerate(pairs)],
        "session_id string, churned int, churn_probability double",
    )


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(400):
        # a third of the rows share one score; some sit next to 0 and 1
        p = rng.choice([0.73, rng.random(), rng.random(), 1e-9 * rng.random(), 0.0, 1.0])
        pairs.append((int(rng.random() < 0.2 + 0.6 * p), p))
    return pairs, scored(spark, pairs).cache()


def test_auc_equals_pair_counting(sample):
    pairs, df = sample
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    got = D.roc_auc(df).first().roc_auc
    assert got == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    assert D.roc_auc(scored(spark, [(1, 0.2), (1, 0.7)])).first().roc_auc is None


def test_summary_equals_pandas(sample):
    pairs, df = sample
    import pandas as pd

    want = pd.Series([p for _, p in pairs]).describe(percentiles=list(S.SUMMARY_PERCENTILES))
    got = D.probability_summary(df).first().asDict()
    assert got["count"] == want["count"]
    for name in ("mean", "std", "min", "max"):
        assert got[name] == pytest.approx(want[name], abs=1e-12)
    for q in S.SUMMARY_PERCENTILES:
        assert got[f"p{round(q * 100):02d}"] == pytest.approx(want[f"{q * 100:g}%"], abs=1e-12)


def test_metrics(spark):
    df = scored(spark, [(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.5), (0, 0.1)])
    got = D.classification_metrics(df).first()  # 0.5 itself is not predicted churn
    assert (got.accuracy, got.precision, got.recall, got.f1_score) == (0.6, 0.5, 0.5, 0.5)
    none = D.classification_metrics(scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert (none.accuracy, none.precision, none.recall, none.f1_score) == (1.0, 0.0, 0.0, 0.0)


def test_report_lines(spark):
    df = scored(spark, [(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.5), (0, 0.1)])
    got = {r.label: r for r in D.classification_report(df).collect()}
    assert got["0"].precision == pytest.approx(2 / 3) and got["0"].support == 3
    assert got["macro avg"].precision == pytest.approx((2 / 3 + 1 / 2) / 2)
    assert got["weighted avg"].recall == pytest.approx((2 / 3 * 3 + 1 / 2 * 2) / 5)
    assert got["accuracy"].f1_score == 0.6 and got["accuracy"].support == 5


def test_thresholds_are_inclusive(spark):
    df = scored(spark, [(1, 0.9), (1, 0.75), (0, 0.75), (0, 0.2)])
    got = {r.threshold: r for r in D.threshold_sweep(df).collect()}
    assert got[0.75].flagged_sessions == 3 and got[0.75].accuracy == 0.75
    assert got[0.80].flagged_sessions == 1 and got[0.80].recall == 0.5
    assert got[0.90].flagged_sessions == 1 and got[0.90].precision == 1.0
    assert tuple(D.high_risk_summary(df).first()) == (0.75, 3, 75.0, 2, 1, 2 / 3, 1.0)
    assert D.brier_score(df).first()[0] == pytest.approx(
        (0.01 + 0.0625 + 0.5625 + 0.04) / 4
    )


def test_calibration_bins_are_right_closed(spark):
    df = scored(spark, [(0, 0.0), (1, 0.1), (1, 0.100001), (0, 0.5), (1, 1.0), (1, 1.5)])
    table = D.calibration_table(df).collect()
    assert [r.sessions for r in table] == [2, 1, 0, 0, 1, 0, 0, 0, 0, 1]
    assert table[0].actual_churn_rate_pct == 50.0
    assert table[0].calibration_gap_pct == pytest.approx(45.0)
    assert table[2].average_predicted_probability_pct is None
    assert [r.bin for r in D.calibration_curve(df).collect()] == [0, 1, 4, 9]


def test_bands(spark):
    values = [0.0, 0.4999, 0.5, 0.6999, 0.7, 0.8499, 0.85, 1.0, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    got = [r[0] for r in df.select(risk.risk_band(df.p)).collect()]
    assert got == ["low"] * 2 + ["medium"] * 2 + ["high"] * 2 + ["critical"] * 3
    missing = spark.sql("SELECT CAST(NULL AS DOUBLE) AS p")
    with pytest.raises(Exception, match="probability is missing"):
        missing.select(risk.risk_band(missing.p)).collect()


def test_distribution_order_and_totals(spark):
    scores = spark.createDataFrame(
        [("a", 95.0, "critical"), ("b", 90.0, "critical"), ("c", 10.0, "low"), ("d", 75.0, "high")],
        "session_id string, churn_risk_score double, risk_band string",
    )
    assert [tuple(r) for r in risk.risk_distribution(scores).collect()] == [
        ("low", 1, 25.0),
        ("high", 1, 25.0),
        ("critical", 2, 50.0),
    ]
    first = risk.risk_distribution(scores, critical_first=True).first()
    assert first.risk_band == "critical"
    assert rows(risk.risk_totals(scores)) == [(4, 2, 67.5)]
    assert [r[0] for r in risk.top_risk_sessions(scores, 2).collect()] == ["a", "b"]


def test_histograms(spark):
    scores = spark.createDataFrame([(0.0,), (2.4,), (2.5,), (100.0,)], "churn_risk_score double")
    assert [tuple(r) for r in reports.risk_histogram(scores).collect()] == [
        (0, 0.0, 2.5, 2),
        (1, 2.5, 5.0, 1),
        (39, 97.5, 100.0, 1),
    ]
    table = spark.createDataFrame(
        [("a", 0, True), ("b", 30, True), ("c", 15, False)],
        "session_id string, events int, flag boolean",
    )
    assert reports.numeric_columns(table) == ["events"]
    got = reports.session_histogram(table, "events").collect()
    assert [(r.bin, r.sessions) for r in got] == [(0, 1), (15, 1), (29, 1)]
    flat = reports.session_histogram(table.where("events = 15"), "events").collect()
    assert [(r.bin, r.sessions) for r in flat] == [(0, 1)]
    with pytest.raises(ValueError):
        reports.session_histogram(table, "flag")
