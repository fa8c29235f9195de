"""Rollups a dashboard reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.columns import round_to, share, side_by_side
from clickloom.operators.interventions import roi_totals

_IDENTIFIERS = ("session_id", "user_id")


def executive_kpis(features: DataFrame, portfolio: DataFrame, roi: DataFrame) -> DataFrame:
    """Sessions, users, churn rate, portfolio size and its value, in one row.

    Features fold to (user, session) before the two distinct counts.
    """
    pairs = features.groupBy("user_id", "session_id").agg(
        F.sum("churned").alias("churned"), F.count("churned").alias("n")
    )
    base = pairs.agg(
        F.count_distinct("session_id").alias("total_sessions"),
        F.count_distinct("user_id").alias("total_users"),
        share(F.sum("churned"), F.sum("n"), None).alias("churn_rate_pct"),
    )
    return side_by_side(
        base,
        portfolio.agg(F.count("*").alias("portfolio_sessions")),
        roi_totals(roi).drop("overall_roi_pct"),
    )


def portfolio_value_by_action(roi: DataFrame) -> DataFrame:
    return (
        roi.groupBy("recommended_action")
        .agg(
            F.count("*").alias("sessions"),
            F.sum("expected_recovery_value").alias("expected_recovery_value"),
            F.sum("intervention_cost").alias("intervention_cost"),
            F.sum("expected_net_value").alias("expected_net_value"),
        )
        .orderBy(F.desc("expected_net_value"), "recommended_action")
    )


def action_roi_summary(roi: DataFrame) -> DataFrame:
    """Sums by action and the mean of the sessions' ROI (not a ratio of sums)."""
    return (
        roi.groupBy("recommended_action")
        .agg(
            F.count("*").alias("sessions"),
            F.sum("expected_recovery_value").alias("expected_recovery_value"),
            F.sum("intervention_cost").alias("intervention_cost"),
            F.sum("expected_net_value").alias("expected_net_value"),
            F.avg("roi_pct").alias("average_roi_pct"),
        )
        .orderBy(F.desc("expected_net_value"), "recommended_action")
    )


def portfolio_summary(roi: DataFrame) -> DataFrame:
    net, cost = F.sum("expected_net_value"), F.sum("intervention_cost")
    return roi.agg(
        F.count("*").alias("selected_sessions"),
        net.alias("total_expected_net_value"),
        F.avg("expected_net_value").alias("average_expected_net_value"),
        F.sum("expected_recovery_value").alias("total_expected_recovery_value"),
        cost.alias("total_intervention_cost"),
        F.when(cost > 0, F.try_divide(net, cost) * 100).otherwise(0.0).alias("portfolio_roi_pct"),
    )


def top_interventions(roi: DataFrame, limit: int = 25) -> DataFrame:
    values = (
        "churn_risk_score",
        "cart_value",
        "expected_recovery_value",
        "intervention_cost",
        "expected_net_value",
        "roi_pct",
    )
    return (
        roi.orderBy("portfolio_rank")
        .limit(limit)
        .select(
            "portfolio_rank",
            "session_id",
            "recommended_action",
            *[round_to(F.col(v), 2).alias(v) for v in values],
        )
    )


def churn_by(features: DataFrame, column: str) -> DataFrame:
    """Sessions and churn rate by device, source, or another small dimension."""
    return (
        features.groupBy(column)
        .agg(
            F.count("*").alias("sessions"),
            round_to(F.avg("churned") * 100, 2).alias("churn_rate_pct"),
        )
        .orderBy(F.desc("churn_rate_pct"), column)
    )


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns fit for a histogram: numeric, not an identifier, not boolean."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in _IDENTIFIERS
    ]


def _histogram(df: DataFrame, column: str, low: Column, width: Column, bins: int) -> DataFrame:
    value = F.col(column).cast("double")
    step = F.coalesce(F.floor(F.try_divide(value - low, width)), F.lit(0))  # width 0: one bin
    index = F.least(F.lit(bins - 1), step)
    return (
        df.where(value.isNotNull())
        .withColumn("_low", low)
        .withColumn("_width", width)
        .groupBy(index.cast("int").alias("bin"), "_low", "_width")
        .agg(F.count("*").alias("sessions"))
        .select(
            "bin",
            (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_start"),
            (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
            "sessions",
        )
        .orderBy("bin")
    )


def risk_histogram(scores: DataFrame, bins: int = 40) -> DataFrame:
    """Sessions per equal-width bin of the 0..100 risk score; filled bins only."""
    return _histogram(scores, "churn_risk_score", F.lit(0.0), F.lit(100.0 / bins), bins)


def session_histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Sessions per equal-width bin between the column's own minimum and
    maximum (two scalars, read by a scalar subquery); filled bins only."""
    if column not in numeric_columns(df):
        raise ValueError(f"not a numeric session metric: {column}")
    value = F.col(column).cast("double")
    low = df.agg(F.min(value)).scalar()
    width = df.agg((F.max(value) - F.min(value)) / bins).scalar()
    return _histogram(df, column, low, width, bins)


def preview(df: DataFrame, *keys: str, limit: int = 100) -> DataFrame:
    return df.orderBy(*keys).limit(limit)
