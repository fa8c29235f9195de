import hashlib
import math

import pytest
from conftest import make_events, rows
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from clickloom.operators import experiments as E


def population(spark, control, treatment):
    """Population with (users, conversions) per variant."""
    data = []
    for variant, (users, conversions) in (("control", control), ("treatment", treatment)):
        data += [(f"{variant}{i}", variant, i < conversions) for i in range(users)]
    return spark.createDataFrame(data, "user_id string, variant string, converted boolean")


def test_assignment_equals_the_hash_rule(spark):
    users = [f"USR-{i:04d}" for i in range(1000)]
    got = dict(
        rows(
            E.assign_variants(spark.createDataFrame([(u,) for u in users], "user_id string")),
            "user_id",
            "variant",
        )
    )
    for user in users:
        digest = hashlib.sha256(f"{user}:EXP-001".encode()).digest()
        want = "control" if int.from_bytes(digest[:8], "big") % 100 < 50 else "treatment"
        assert got[user] == want
    assert set(got.values()) == {"control", "treatment"}
    known = spark.range(1).select(E.assignment_bucket(F.lit("USR-TEST-001"), F.lit("EXP-001")))
    assert int(known.first()[0]) == 82


def test_population(spark):
    t = {"variant": "treatment"}
    events = make_events(
        spark,
        [
            ("s1", "user_1", "10:00", "homepage_view"),
            ("s1", "user_1", "10:01", "purchase_complete"),
            ("s2", "user_2", "10:00", "homepage_view", t),
            ("s3", "user_3", "10:00", "homepage_view", t),
            ("s3", "user_3", "10:01", "purchase_complete", t),
            ("s4", "user_4", "10:00", "product_click"),
            ("s5", "two_variants", "10:00", "homepage_view"),
            ("s5", "two_variants", "10:01", "homepage_view", t),
            ("s6", "no_experiment", "10:00", "homepage_view", {"experiment_id": None}),
        ],
    )
    people = E.experiment_population(events)
    assert rows(people) == [
        ("user_1", "control", True),
        ("user_2", "treatment", False),
        ("user_3", "treatment", True),
    ]
    assert rows(E.experiment_summary(people)) == [
        ("control", 1, 1, 100.0),
        ("treatment", 2, 1, 50.0),
    ]
    assert rows(E.population_integrity(people)) == [(3, 3, 0)]
    assert rows(E.population_reconciliation(events, people)) == [(5, 3, True)]
    assert rows(E.conversion_overflow(people)) == []


def test_conversion_counts_events_outside_the_experiment(spark):
    events = make_events(
        spark,
        [
            ("s1", "u", "10:00", "homepage_view"),
            ("s1", "u", "10:01", "purchase_complete", {"experiment_id": None, "variant": "other"}),
        ],
    )
    assert rows(E.experiment_population(events)) == [("u", "control", True)]


def test_inference_golden(spark):
    r = E.analyze_experiment(population(spark, (100, 10), (100, 30))).first()
    assert (r.control_conversion_rate, r.treatment_conversion_rate) == (0.10, 0.30)
    assert r.absolute_lift == pytest.approx(0.20) and r.relative_lift == pytest.approx(2.0)
    assert r.z_statistic == pytest.approx(3.5355, abs=1e-4)
    assert r.chi_square_statistic == pytest.approx(12.5)
    assert r.z_test_p_value == pytest.approx(0.000406952, abs=1e-9)
    assert r.chi_square_p_value == pytest.approx(r.z_test_p_value)
    assert r.confidence_interval_lower > 0 and r.confidence_interval_upper > 0
    assert r.statistically_significant and r.recommendation.endswith("Recommend rollout.")


def test_chi_square_equals_spark_ml(spark):
    people = population(spark, (80, 33), (120, 61))
    ours = E.analyze_experiment(people).first()
    data = people.select(
        F.col("converted").cast("double").alias("label"),
        (F.col("variant") == "treatment").cast("double").alias("x"),
    )
    vectors = VectorAssembler(inputCols=["x"], outputCol="features").transform(data)
    theirs = ChiSquareTest.test(vectors, "features", "label").first()
    assert ours.chi_square_statistic == pytest.approx(theirs.statistics[0])
    assert ours.chi_square_p_value == pytest.approx(theirs.pValues[0])


@pytest.mark.parametrize(
    "control, treatment, text",
    [
        ((100, 30), (100, 10), "Do not roll out."),
        ((100, 10), (100, 12), "Continue experiment."),
        ((100, 10), (100, 30), "Recommend rollout."),
    ],
)
def test_decisions(spark, control, treatment, text):
    result = E.analyze_experiment(population(spark, control, treatment))
    assert result.first().recommendation.endswith(text)
    assert E.ab_consistency(result).first().is_consistent


def test_no_control_conversions(spark):
    assert math.isnan(E.ab_test(population(spark, (50, 0), (50, 9))).first().relative_lift)


def test_rejected_inputs(spark):
    people = population(spark, (10, 1), (10, 2))
    for level in (0.0, 1.0):
        with pytest.raises(ValueError):
            E.analyze_experiment(people, significance_level=level)
        with pytest.raises(ValueError):
            E.analyze_experiment(people, confidence_level=level)
    with pytest.raises(Exception, match="exactly control and treatment"):
        E.ab_test(people.where("variant = 'control'")).collect()
    third = people.withColumn("variant", F.lit("other")).unionByName(people)
    with pytest.raises(Exception, match="exactly control and treatment"):
        E.ab_test(third).collect()
    with pytest.raises(Exception, match="zero variance"):
        E.ab_test(population(spark, (10, 10), (10, 10))).collect()


def test_lifts(spark):
    summary = E.experiment_summary(population(spark, (100, 10), (100, 30)))
    assert rows(E.displayed_lift(summary)) == [(20.0, 200.0)]
    nothing = E.experiment_summary(population(spark, (100, 0), (100, 30)))
    assert rows(E.displayed_lift(nothing)) == [(30.0, 0.0)]
    assert rows(E.displayed_lift(summary.limit(1))) == []


def test_session_ab(spark):
    t = {"variant": "treatment"}
    events = make_events(
        spark,
        [
            ("s1", "a", "10:00", "purchase_complete"),
            ("s1", "a", "10:01", "search"),
            ("s2", "a", "10:00", "search"),
            ("s3", "b", "10:00", "purchase_complete", t),
        ],
    )
    assert rows(E.session_ab(events)) == [
        ("control", 2, 1, 50.0, 50.0, 100.0),
        ("treatment", 1, 1, 100.0, 50.0, 100.0),
    ]
    assert rows(E.variant_share(events)) == [("control", 1, 50.0), ("treatment", 1, 50.0)]
