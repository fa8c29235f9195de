"""Churn classifiers with Spark ML: preprocessing, training, scoring, storage."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.functions.columns import side_by_side
from clickloom.operators.diagnostics import LABEL, classification_metrics, roc_auc
from clickloom.operators.risk import risk_scores

_NUMERIC = list(S.NUMERIC_FEATURES)
_CATEGORICAL = list(S.CATEGORICAL_FEATURES)
_WEIGHT = "class_weight"
_LEAF = 20  # sessions of a leaf, at least

LOGISTIC = "Logistic Regression"
BOOSTING = "Gradient Boosting"


# --------------------------------------------------------------- preprocessing
def preprocessing_stages() -> list:
    """Scale the numeric features, one-hot the categorical ones, drop the rest.

    An unseen category takes the extra index of "keep", which the encoder
    drops: it becomes all zeros. Outcomes and timestamps never enter.
    """
    indexed = [f"{c}_index" for c in _CATEGORICAL]
    encoded = [f"{c}_onehot" for c in _CATEGORICAL]
    return [
        VectorAssembler(inputCols=_NUMERIC, outputCol="numeric"),
        StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True, withStd=True),
        StringIndexer(inputCols=_CATEGORICAL, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=["scaled", *encoded], outputCol="features"),
    ]


def preprocess(features: DataFrame) -> DataFrame:
    """session_id, label and the model's feature vector."""
    model = Pipeline(stages=preprocessing_stages()).fit(features)
    return model.transform(features).select("session_id", LABEL, "features")


# ----------------------------------------------------------------------- split
def _bucket(seed: int) -> Column:
    """One of 65,536 buckets by SHA-256 of session and seed."""
    digest = F.sha2(F.concat_ws(":", F.col("session_id"), F.lit(str(seed))), 256)
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")


def in_test_part(features: DataFrame, test_share: float = 0.20, seed: int = 42) -> Column:
    """True for the test sessions, the same on every run and cluster.

    Of each label, the buckets up to a cut of its own are the test part: the
    first bucket at which the label's share is reached, so each label holds its
    share to within one bucket. Cuts come from counts per label and bucket.
    """
    per_label = Window.partitionBy(LABEL)
    cuts = (
        features.groupBy(LABEL, _bucket(seed).alias("bucket"))
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(per_label.orderBy("bucket")) - F.col("n"))
        .withColumn("total", F.sum("n").over(per_label))
        .where(F.col("before") < F.col("total") * test_share)
        .groupBy(LABEL)
        .agg(F.max("bucket").alias("cut"))
        .collect()  # one row a label
    )
    cut = F.lit(-1)
    for row in cuts:
        cut = F.when(F.col(LABEL).eqNullSafe(F.lit(row[LABEL])), row["cut"]).otherwise(cut)
    return _bucket(seed) <= cut


def split(features: DataFrame, test_share: float = 0.20, seed: int = 42):
    test = in_test_part(features, test_share, seed)
    return features.where(~test), features.where(test)


# -------------------------------------------------------------------- training
def _label_counts(features: DataFrame) -> dict[int, int]:
    """Rows per label: two numbers."""
    return {r[LABEL]: r["n"] for r in features.groupBy(LABEL).agg(F.count("*").alias("n")).collect()}


def train_logistic(features: DataFrame, max_iter: int = 1000) -> PipelineModel:
    """Balanced logistic regression with an L2 penalty of strength 1.

    Each class weighs n / (2 * n_class); the weights sum to n, so the penalty
    per unit of weight is 1 / n.
    """
    counts = _label_counts(features)
    n = sum(counts.values())
    balance = reduce(
        lambda rest, item: F.when(F.col(LABEL) == item[0], n / (len(counts) * item[1])).otherwise(
            rest
        ),
        counts.items(),
        F.lit(None).cast("double"),
    )
    estimator = LogisticRegression(
        labelCol=LABEL,
        weightCol=_WEIGHT,
        maxIter=max_iter,
        regParam=1.0 / n,
        standardization=False,
    )
    return _fit_prepared(features.withColumn(_WEIGHT, balance), estimator)


def train_boosting(features: DataFrame, max_iter: int = 200, seed: int = 42) -> PipelineModel:
    """Gradient boosted trees: step 0.05, 200 rounds, up to 32 leaves of 20 sessions or more.

    Sessions equal in all features and the label are one row with their number as
    its weight: they fall into one leaf in every round, and each round passes over
    the rows once a level. A leaf's sessions are the sum of its weights.
    """
    n = sum(_label_counts(features).values())
    estimator = GBTClassifier(
        labelCol=LABEL,
        weightCol=_WEIGHT,
        stepSize=0.05,
        maxIter=max_iter,
        maxDepth=5,
        maxBins=256,
        # weights are whole numbers: half a session less than 20, so that rounding decides nothing
        minWeightFractionPerNode=min((_LEAF - 0.5) / max(n, 1), 0.499),
        seed=seed,
    )
    return _fit_prepared(features, estimator, folded(features))


def folded(features: DataFrame) -> DataFrame:
    """The distinct rows of features and label, with the number of sessions that have them."""
    count = F.count(F.lit(1)).cast("double").alias(_WEIGHT)
    return features.groupBy(*_NUMERIC, *_CATEGORICAL, LABEL).agg(count)


def _fit_prepared(features: DataFrame, estimator, rows: DataFrame | None = None) -> PipelineModel:
    """Fit the preprocessing, then the estimator on its output, for ``rows`` if given.

    Not persisted here: the estimators keep their own compact form of the rows,
    but only while their input is not persisted.
    """
    ready = Pipeline(stages=preprocessing_stages()).fit(features)
    fitted = estimator.fit(ready.transform(features if rows is None else rows))
    return PipelineModel(stages=[*ready.stages, fitted])


# --------------------------------------------------------------------- scoring
def with_probability(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The feature rows with ``churn_probability``."""
    probability = vector_to_array("probability")[1]
    return (
        model.transform(features)
        .withColumn("churn_probability", probability)
        .select(*features.columns, "churn_probability")
    )


def score_sessions(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Risk score table of every session."""
    return risk_scores(with_probability(model, features))


# ------------------------------------------------------------------ evaluation
def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Feature names and coefficients of a logistic model, strongest first."""
    indexer = next(s for s in model.stages if hasattr(s, "labelsArray"))
    classifier = model.stages[-1]
    names = list(_NUMERIC)
    for column, labels in zip(_CATEGORICAL, indexer.labelsArray):
        names += [f"{column}_{label}" for label in labels]
    rows = [(n, float(c), abs(float(c))) for n, c in zip(names, classifier.coefficients)]
    return spark.createDataFrame(
        rows, "feature string, coefficient double, absolute_coefficient double"
    ).orderBy(F.desc("absolute_coefficient"), "feature")


def evaluate(name: str, model: PipelineModel, test: DataFrame) -> DataFrame:
    """One row: model, accuracy, precision, recall, f1_score, roc_auc."""
    scored = with_probability(model, test).select(LABEL, "churn_probability")
    return side_by_side(classification_metrics(scored), roc_auc(scored)).select(
        F.lit(name).alias("model"), "*"
    )


def compare_models(
    train: DataFrame, test: DataFrame, logistic_iter: int = 1000, boosting_iter: int = 200
) -> DataFrame:
    """Both classifiers on the same split, best ROC AUC first."""
    return compare_fitted(
        {
            LOGISTIC: train_logistic(train, logistic_iter),
            BOOSTING: train_boosting(train, boosting_iter),
        },
        test,
    )


def compare_fitted(candidates: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """Fitted models by name on the test part, best ROC AUC first."""
    rows = [evaluate(name, model, test) for name, model in candidates.items()]
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("roc_auc"), "model")


# --------------------------------------------------------------------- storage
def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def model_exists(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.text(f"{path}/metadata").isEmpty()
    except AnalysisException:
        return False


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    if not model_exists(spark, path):
        raise FileNotFoundError(f"no churn model at {path}; train the final model first")
    return PipelineModel.load(path)
