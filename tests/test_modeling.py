import random

import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.operators import modeling as M


@pytest.fixture(scope="module")
def table(spark):
    """Sessions whose churn follows checkout starts and duration."""
    rng = random.Random(5)
    data = []
    for i in range(600):
        starts, views = rng.randrange(3), rng.randrange(6)
        duration = rng.random() * 30
        churned = int(rng.random() < (0.85 if starts == 0 else 0.2 + 0.01 * duration))
        data.append(
            (f"u{i % 50}", f"s{i}", views + starts, 1 + (starts > 0), views, starts % 2, 0, starts,
             0, 0, duration, rng.choice(["mobile", "desktop"]), rng.choice(["email", "direct"]),
             int(starts % 2), int(starts > 0), 1 - churned, churned)
        )
    names = ("user_id", "session_id", *S.NUMERIC_FEATURES, *S.CATEGORICAL_FEATURES,
             "has_cart", "reached_checkout", "purchased", "churned")
    kinds = ["string", "string"] + ["long"] * 8 + ["double", "string", "string"] + ["int"] * 4
    return (
        spark.createDataFrame(data, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
        .withColumn("observation_timestamp", F.expr("timestamp_ntz'2026-01-01 00:00:00'"))
        .cache()
    )


@pytest.fixture(scope="module")
def logistic(table):
    return M.train_logistic(table)


def test_features_exclude_outcomes():
    outcomes = {"user_id", "session_id", "purchased", "churned", "has_cart", "reached_checkout"}
    assert not set(S.FEATURE_COLUMNS) & outcomes
    assert not [c for c in S.FEATURE_COLUMNS if c.endswith("timestamp")]


def test_unseen_category_is_all_zeros(spark, table, logistic):
    odd = table.limit(1).withColumn("device_type", F.lit("toaster"))
    got = logistic.transform(odd).select(vector_to_array("device_type_onehot")).first()[0]
    assert got == [0.0, 0.0]


def test_scaled_features_are_centered(table):
    vectors = M.preprocess(table).select(vector_to_array("features").alias("v"))
    means = vectors.select(*[F.avg(F.col("v")[i]) for i in range(9)]).first()
    assert all(abs(m) < 1e-9 for m in means)


def test_split_is_stable_and_complete(table):
    train, test = M.split(table)
    again = M.split(table.repartition(7))[1]
    assert rows(test, "session_id") == rows(again, "session_id")
    assert train.count() + test.count() == 600 and 80 < test.count() < 160


def test_logistic_learns_and_balances(spark, table, logistic):
    scored = M.with_probability(logistic, table)
    r = M.evaluate("m", logistic, table).first()
    assert r.roc_auc > 0.7
    # balanced classes: mean probability near one half, not near the churn rate
    assert abs(scored.agg(F.avg("churn_probability")).first()[0] - 0.5) < 0.1
    names = [r.feature for r in M.coefficients(spark, logistic).collect()]
    assert len(names) == 13 and "device_type_mobile" in names
    assert names[0] in ("checkout_starts", "unique_event_types", "total_actions_so_far")


def test_comparison_and_boosting(table):
    train, test = M.split(table)
    got = M.compare_models(train, test, logistic_iter=50, boosting_iter=5).collect()
    assert {r.model for r in got} == {M.LOGISTIC, M.BOOSTING}
    assert got[0].roc_auc >= got[1].roc_auc > 0.5


def test_model_roundtrip(spark, table, logistic, folder):
    with pytest.raises(FileNotFoundError):
        M.load_model(spark, f"{folder}/none")
    path = M.save_model(logistic, f"{folder}/model")
    M.save_model(logistic, path)  # replaces
    copy = M.load_model(spark, path)
    assert rows(M.score_sessions(copy, table)) == rows(M.score_sessions(logistic, table))


def test_score_table(table, logistic):
    got = M.score_sessions(logistic, table)
    assert got.columns == ["user_id", "session_id", "observation_timestamp", "has_cart",
                           "reached_checkout", "purchased", "churn_probability",
                           "churn_risk_score", "risk_band"]
    assert got.where("churn_risk_score NOT BETWEEN 0 AND 100").count() == 0


def test_boosting_folds_equal_sessions(spark, table):
    """Equal sessions are one weighted row of the fit; the trees are those of the rows one by one."""
    import pyspark.ml.classification as C

    twice = table.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("n").withColumn(
        "observed_session_duration_minutes", F.round("observed_session_duration_minutes", 0)
    )
    rows_of = M.folded(twice)
    assert rows_of.agg(F.sum("class_weight")).first()[0] == twice.count() == 1200
    assert rows_of.count() <= 600
    seen, fit = [], C.GBTClassifier.fit
    C.GBTClassifier.fit = lambda self, data: seen.append(data.count()) or fit(self, data)
    try:
        got = M.with_probability(M.train_boosting(twice, 5), twice)
    finally:
        C.GBTClassifier.fit = fit
    assert seen == [rows_of.count()]
    plain = C.GBTClassifier(
        labelCol="churned", stepSize=0.05, maxIter=5, maxDepth=5, maxBins=256, minInstancesPerNode=20, seed=42
    )
    want = M.with_probability(M._fit_prepared(twice, plain), twice)
    both = got.select("session_id", "churn_probability").distinct().join(
        want.select("session_id", F.col("churn_probability").alias("p")).distinct(), "session_id"
    )
    assert both.where(F.abs(F.col("churn_probability") - F.col("p")) > 1e-9).count() == 0 and both.count() >= 600
