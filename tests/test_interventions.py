import datetime as dt

import pytest
from conftest import make_events, rows
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.operators import contracts as K
from clickloom.operators import interventions as I
from clickloom.operators import reports

NOW = dt.datetime(2026, 1, 1)


def scores(spark, data):
    """(session, probability, band, has_cart, reached_checkout, payment_errors)"""
    return spark.createDataFrame(
        [("u", s, NOW, c, k, 0, p, p * 100, b, e) for s, p, b, c, k, e in data],
        "user_id string, session_id string, observation_timestamp timestamp_ntz, has_cart int, "
        "reached_checkout int, purchased int, churn_probability double, "
        "churn_risk_score double, risk_band string, payment_errors long",
    )


CASES = [
    ("pay", 0.9, "critical", 1, 1, 2),
    ("checkout", 0.8, "high", 1, 1, 0),
    ("cart", 0.8, "high", 1, 0, 0),
    ("error_no_checkout", 0.9, "critical", 1, 0, 1),
    ("nothing", 0.9, "critical", 0, 0, 0),
    ("medium", 0.6, "medium", 1, 1, 1),
    ("low", 0.1, "low", 1, 1, 1),
]
VALUES = [("pay", 100.0), ("checkout", 200.0), ("cart", 10.0), ("medium", 50.0)]


@pytest.fixture(scope="module")
def candidates(spark):
    return I.intervention_candidates(scores(spark, CASES))


@pytest.fixture(scope="module")
def economics(spark, candidates):
    values = spark.createDataFrame(VALUES, "session_id string, cart_value double")
    return I.intervention_economics(candidates, values)


def test_rule(candidates):
    got = {r[0]: tuple(r)[1:] for r in candidates.select(
        "session_id", "recommended_action", "intervention_priority").collect()}
    assert got == {
        "pay": ("payment_recovery", "critical"),
        "checkout": ("checkout_recovery", "high"),
        "cart": ("cart_recovery", "high"),
        "error_no_checkout": ("no_action", "low"),
        "nothing": ("no_action", "low"),
        "medium": ("monitor", "medium"),
        "low": ("no_action", "low"),
    }
    assert rows(I.action_distribution(candidates))[-1] == ("payment_recovery", 1)
    assert I.priority_distribution(candidates).first().intervention_priority == "low"


def test_economics(economics):
    got = {r.session_id: r for r in economics.collect()}
    assert got["pay"].expected_recovery_value == pytest.approx(100 * 0.9 * 0.35)
    assert got["pay"].expected_net_value == pytest.approx(100 * 0.9 * 0.35 - 8)
    assert got["cart"].expected_net_value == pytest.approx(10 * 0.8 * 0.12 - 3)
    assert got["cart"].business_priority_score == 0.0
    assert got["nothing"].cart_value == 0.0 and got["nothing"].intervention_cost == 0.0
    by_action = {r[0]: r for r in I.economics_by_action(economics).collect()}
    assert by_action["no_action"].sessions == 3
    assert I.top_opportunities(economics, 1).first().session_id == "checkout"


def test_unknown_action_fails(spark, candidates):
    odd = candidates.withColumn("recommended_action", F.lit("call"))
    values = spark.createDataFrame(VALUES, "session_id string, cart_value double")
    with pytest.raises(Exception, match="no assumptions for action call"):
        I.intervention_economics(odd, values).collect()
    own = {"call": ("high", 0.5, 1.0)}
    got = I.intervention_economics(odd, values, own).where("session_id = 'pay'").first()
    assert got.expected_recovery_value == pytest.approx(100 * 0.9 * 0.5)


def test_portfolio(economics):
    with pytest.raises(ValueError):
        I.intervention_portfolio(economics, 0)
    assert rows(I.intervention_portfolio(economics, 2), "portfolio_rank", "session_id") == [
        (1, "checkout"),
        (2, "pay"),
    ]
    # beyond the eligible count all recoveries are taken, also one of score 0
    assert rows(I.intervention_portfolio(economics, 99), "portfolio_rank", "session_id") == [
        (1, "checkout"),
        (2, "pay"),
        (3, "cart"),
    ]


def test_portfolio_ties_follow_the_session(spark):
    same = [(f"s{i}", 0.8, "high", 1, 0, 0) for i in (3, 1, 2)]
    values = spark.createDataFrame([(f"s{i}", 50.0) for i in (1, 2, 3)],
                                   "session_id string, cart_value double")
    table = I.intervention_economics(I.intervention_candidates(scores(spark, same)), values)
    got = I.intervention_portfolio(table, 2)
    assert [r.session_id for r in got.orderBy("portfolio_rank").collect()] == ["s1", "s2"]


def test_roi(economics):
    portfolio = I.intervention_portfolio(economics)
    roi = I.intervention_roi(portfolio.withColumn(
        "intervention_cost",
        F.when(F.col("session_id") == "cart", 0.0).otherwise(F.col("intervention_cost")),
    ))
    got = {r.session_id: r.roi_pct for r in roi.collect()}
    assert got["cart"] == 0.0
    assert got["checkout"] == pytest.approx((200 * 0.8 * 0.2 - 5) / 5 * 100)

    roi = I.intervention_roi(portfolio)
    totals = I.roi_totals(roi).first()
    assert totals.overall_roi_pct == pytest.approx(
        totals.expected_net_value / totals.intervention_cost * 100
    )
    by_action = I.roi_by_action(roi).collect()
    assert sum(r.expected_net_value for r in by_action) == pytest.approx(totals.expected_net_value)
    assert I.roi_totals(roi.limit(0)).first().overall_roi_pct == 0.0
    assert I.top_roi(roi, 1).first().session_id == "checkout"
    assert reports.portfolio_summary(roi).first().selected_sessions == 3
    assert reports.top_interventions(roi, 2).count() == 2
    assert reports.action_roi_summary(roi).count() == 3


def test_mean_of_ratios_is_not_ratio_of_sums(spark):
    roi = spark.createDataFrame(
        [("cart_recovery", 10.0, 1.0, 9.0, 900.0), ("cart_recovery", 10.0, 9.0, 1.0, 100 / 9)],
        "recommended_action string, expected_recovery_value double, intervention_cost double, "
        "expected_net_value double, roi_pct double",
    ).withColumn("session_id", F.lit("s"))
    assert I.roi_by_action(roi).first().roi_pct == 100.0
    assert reports.action_roi_summary(roi).first().average_roi_pct == pytest.approx(
        (900 + 100 / 9) / 2
    )


def test_cart_value(spark):
    events = make_events(
        spark,
        [
            ("s1", "u", "10:00", "cart_view", {"cart_value": 5.0}),
            ("s1", "u", "10:01", "cart_view", {"cart_value": 9.0}),
            ("s2", "u", "10:00", "search"),
            ("s3", "u", "10:00", "cart_view", {"cart_value": -2.0}),
        ],
    )
    assert rows(I.session_cart_value(events)) == [("s1", 9.0), ("s2", 0.0), ("s3", -2.0)]


# -------------------------------------------------------------------- contracts
def test_reconcile(spark):
    def keys(*values):
        return spark.createDataFrame([(v,) for v in values], "session_id string")

    got = K.reconcile(keys("a", "b", "b", None), keys("b", "c")).first().asDict()
    assert got == {
        "left_rows": 4,
        "right_rows": 2,
        "left_keys": 2,
        "right_keys": 2,
        "left_duplicates": 1,
        "right_duplicates": 0,
        "missing_right": 2,  # a and the NULL key
        "missing_left": 1,
    }


def test_score_contract(spark):
    good = scores(spark, CASES)
    assert K.score_contract(good, good).first().passed
    broken = good.withColumn("risk_band", F.lit("odd")).withColumn("churn_risk_score", F.lit(101.0))
    report = K.score_contract(good, broken.unionByName(broken.limit(1))).first()
    assert report.invalid_risk_bands == 8 and report.out_of_range_scores == 8
    assert report.duplicate_sessions == 1 and not report.passed
    with pytest.raises(K.ContractError):
        K.require(K.score_contract(good, broken), "scores")


def test_candidate_contract(spark, candidates):
    table = scores(spark, CASES)
    assert K.candidate_contract(table, candidates).first().passed
    wrong = candidates.withColumn("intervention_priority", F.lit("low"))
    assert K.candidate_contract(table, wrong).first().inconsistent_actions == 4
    fewer = K.candidate_contract(table, candidates.where("session_id <> 'pay'")).first()
    assert fewer.missing_interventions == 1 and not fewer.passed


def test_roi_contract(economics):
    portfolio = I.intervention_portfolio(economics)
    roi = I.intervention_roi(portfolio)
    assert K.roi_contract(portfolio, roi).first().passed
    off = roi.withColumn("roi_pct", F.col("roi_pct") + 1)
    assert K.roi_contract(portfolio, off).first().invalid_roi_rows == 3
    off = roi.withColumn("expected_net_value", F.lit(float("nan")))
    assert K.roi_contract(portfolio, off).first().missing_values == 3


def test_warehouse_contract(spark, candidates, economics):
    table = scores(spark, CASES)
    portfolio = I.intervention_portfolio(economics)
    roi = I.intervention_roi(portfolio)

    def check(**changes):
        tables = dict(features=table, scores=table, candidates=candidates,
                      economics=economics, portfolio=portfolio, roi=roi)
        tables.update(changes)
        return K.warehouse_contract(**tables).first()

    assert check().passed
    assert check(roi=roi.limit(2)).portfolio_missing_roi == 1
    blank = candidates.withColumn("recommended_action", F.lit("  "))
    assert check(candidates=blank).missing_recommended_actions == len(CASES)
    assert not check(scores=table.unionByName(table)).passed
    assert not K.warehouse_contract(table, table, candidates, economics, portfolio, roi,
                                    capacity=2).first().capacity_respected


def test_kpis(spark, economics):
    table = scores(spark, CASES).withColumn("churned", F.lit(1))
    portfolio = I.intervention_portfolio(economics)
    got = reports.executive_kpis(table, portfolio, I.intervention_roi(portfolio)).first()
    assert (got.total_sessions, got.total_users, got.churn_rate_pct) == (7, 1, 100.0)
    assert got.portfolio_sessions == 3 and got.intervention_cost == 16.0
    assert S.DEFAULT_CAPACITY == 500
