"""Risk scores and bands from a churn probability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.functions.columns import distribution, ranked_by, tally

_CRITICAL_FIRST = tuple(reversed(S.RISK_BANDS))


def risk_band(probability: Column) -> Column:
    """low, medium, high or critical; a missing probability fails the job."""
    low, medium, high = S.RISK_CUTS
    missing = F.raise_error(F.lit("churn probability is missing")).cast("string")
    return (
        F.when(probability.isNull(), missing)
        .when(probability < low, "low")
        .when(probability < medium, "medium")
        .when(probability < high, "high")
        .otherwise("critical")
    )


def risk_scores(scored: DataFrame) -> DataFrame:
    """Score table from features that carry ``churn_probability``."""
    p = F.col("churn_probability")
    return scored.select(
        "user_id",
        "session_id",
        "observation_timestamp",
        "has_cart",
        "reached_checkout",
        "purchased",
        "churn_probability",
        (p * 100).alias("churn_risk_score"),
        risk_band(p).alias("risk_band"),
    )


def risk_distribution(scores: DataFrame, critical_first: bool = False) -> DataFrame:
    order = _CRITICAL_FIRST if critical_first else S.RISK_BANDS
    return distribution(scores, "risk_band").orderBy(ranked_by("risk_band", order))


def top_risk_sessions(scores: DataFrame, limit: int = 50) -> DataFrame:
    return (
        scores.select("session_id", "churn_risk_score", "risk_band")
        .orderBy(F.desc("churn_risk_score"), "session_id")
        .limit(limit)
    )


def risk_totals(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.count("*").alias("scored_sessions"),
        tally(F.col("risk_band") == "critical").alias("critical_sessions"),
        F.avg("churn_risk_score").alias("average_risk_score"),
    )
