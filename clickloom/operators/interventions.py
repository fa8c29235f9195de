"""Intervention rule, expected economics, portfolio and ROI."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.functions.columns import distribution, round_to
from clickloom.session import fresh_folder

ECONOMICS_COLUMNS = (
    "user_id",
    "session_id",
    "observation_timestamp",
    "recommended_action",
    "intervention_priority",
    "risk_band",
    "churn_probability",
    "churn_risk_score",
    "cart_value",
    "recovery_probability",
    "intervention_cost",
    "expected_recovery_value",
    "expected_net_value",
    "business_priority_score",
)


# ------------------------------------------------------------------- decision
def recommended_action() -> Column:
    """First matching rule. A high-risk session with a payment error but no
    checkout matches none of the recoveries."""
    at_risk = F.col("risk_band").isin("high", "critical")
    errors, checkout = F.col("payment_errors"), F.col("reached_checkout") == 1
    return (
        F.when(at_risk & checkout & (errors > 0), "payment_recovery")
        .when(at_risk & checkout & (errors == 0), "checkout_recovery")
        .when(at_risk & (F.col("has_cart") == 1) & (errors == 0), "cart_recovery")
        .when(F.col("risk_band") == "medium", "monitor")
        .otherwise("no_action")
    )


def _by_action(index: int, action: Column) -> Column:
    """Entry ``index`` of the fixed action table; NULL for unknown actions."""
    value = F.lit(None)
    for name, entry in S.ACTIONS.items():
        value = F.when(action == name, F.lit(entry[index])).otherwise(value)
    return value


def with_payment_errors(scores: DataFrame, features: DataFrame) -> DataFrame:
    """Scores with the payment errors of their session (one row per session)."""
    return scores.join(features.select("session_id", "payment_errors"), "session_id")


def intervention_candidates(scores: DataFrame) -> DataFrame:
    """Action and priority of every scored session (needs payment_errors)."""
    return scores.select(
        "user_id",
        "session_id",
        "observation_timestamp",
        "churn_probability",
        "churn_risk_score",
        "risk_band",
        "has_cart",
        "reached_checkout",
        "payment_errors",
        recommended_action().alias("recommended_action"),
    ).withColumn("intervention_priority", _by_action(0, F.col("recommended_action")))


def action_distribution(candidates: DataFrame) -> DataFrame:
    return distribution(candidates, "recommended_action", percentage=False).orderBy(
        F.desc("sessions"), "recommended_action"
    )


def priority_distribution(candidates: DataFrame) -> DataFrame:
    return distribution(candidates, "intervention_priority", percentage=False).orderBy(
        F.desc("sessions"), "intervention_priority"
    )


# ------------------------------------------------------------------ economics
def session_cart_value(events: DataFrame) -> DataFrame:
    """Highest cart value of each session, 0 where none was recorded."""
    return events.groupBy("session_id").agg(
        F.max(F.coalesce("cart_value", F.lit(0.0))).alias("cart_value")
    )


def intervention_economics(
    candidates: DataFrame,
    cart_values: DataFrame,
    assumptions: dict[str, tuple[str, float, float]] | None = None,
) -> DataFrame:
    """Expected recovery, cost and net value of every candidate.

    ``assumptions`` maps action to (priority, recovery_probability, cost). An
    action outside it fails the job.
    """
    table = S.ACTIONS if assumptions is None else assumptions
    action = F.col("recommended_action")

    def assumed(index: int) -> Column:
        unknown = F.concat(F.lit("no assumptions for action "), F.coalesce(action, F.lit("NULL")))
        value = F.raise_error(unknown).cast("double")
        for name, entry in table.items():
            value = F.when(action == name, F.lit(float(entry[index]))).otherwise(value)
        return value

    net = F.col("expected_net_value")
    return (
        candidates.join(cart_values, "session_id", "left")
        .withColumn("cart_value", F.coalesce("cart_value", F.lit(0.0)))
        .withColumn("recovery_probability", assumed(1))
        .withColumn("intervention_cost", assumed(2))
        .withColumn(
            "expected_recovery_value",
            F.col("cart_value") * F.col("churn_probability") * F.col("recovery_probability"),
        )
        .withColumn(
            "expected_net_value",
            F.col("expected_recovery_value") - F.col("intervention_cost"),
        )
        .withColumn("business_priority_score", F.greatest(net, F.lit(0.0)))
        .select(*ECONOMICS_COLUMNS)
    )


def economics_by_action(economics: DataFrame) -> DataFrame:
    return (
        economics.groupBy("recommended_action")
        .agg(
            F.count("session_id").alias("sessions"),
            round_to(F.avg("cart_value"), 2).alias("avg_cart_value"),
            round_to(F.sum("expected_recovery_value"), 2).alias("total_expected_recovery_value"),
            round_to(F.sum("intervention_cost"), 2).alias("total_intervention_cost"),
            round_to(F.sum("expected_net_value"), 2).alias("total_expected_net_value"),
        )
        .orderBy("recommended_action")
    )


def top_opportunities(economics: DataFrame, limit: int = 10) -> DataFrame:
    return (
        economics.select(
            "session_id",
            "recommended_action",
            "churn_risk_score",
            "cart_value",
            "expected_net_value",
            "business_priority_score",
        )
        .orderBy(F.desc("business_priority_score"), "session_id")
        .limit(limit)
    )


# ------------------------------------------------------------------- portfolio
IN_ONE_TASK = 100_000  # rows that one task may rank
_PORTFOLIO_ORDER = (
    "business_priority_score",
    "expected_net_value",
    "churn_risk_score",
)


def intervention_portfolio(
    economics: DataFrame, capacity: int = S.DEFAULT_CAPACITY
) -> DataFrame:
    """The ``capacity`` most valuable recoveries, ranked from 1.

    Up to ``IN_ONE_TASK`` rows, sort and limit plan as a distributed top-k and
    the ranking window sees the selected rows only. A larger portfolio is
    sorted by range, written, and numbered inside each partition; the counts
    of the partitions before it are added. Equal values are ordered by
    session_id.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    if capacity > IN_ONE_TASK:
        return _ranked_by_range(economics, capacity)
    order = [F.desc(c) for c in _PORTFOLIO_ORDER] + [F.asc("session_id")]
    chosen = (
        economics.where(F.col("recommended_action").isin(*S.RECOVERY_ACTIONS))
        .orderBy(*order)
        .limit(capacity)
    )
    rank = F.row_number().over(Window.orderBy(*order)).cast("long")
    return chosen.select(rank.alias("portfolio_rank"), *ECONOMICS_COLUMNS)


def _ranked_by_range(economics: DataFrame, capacity: int) -> DataFrame:
    order = [F.desc(c) for c in _PORTFOLIO_ORDER] + [F.asc("session_id")]
    spark, path = economics.sparkSession, fresh_folder(economics.sparkSession, "portfolio")
    (
        economics.where(F.col("recommended_action").isin(*S.RECOVERY_ACTIONS))
        .orderBy(*order)
        .select(F.monotonically_increasing_id().alias("_place"), *ECONOMICS_COLUMNS)
        .write.parquet(path)
    )
    # The upper bits of the place are the partition, the lower 33 the row in it.
    placed = spark.read.parquet(path).withColumn("_part", F.shiftright("_place", 33))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(offsets, "_part")
        .withColumn("portfolio_rank", F.col("_before") + inside + 1)
        .where(F.col("portfolio_rank") <= capacity)
        .select("portfolio_rank", *ECONOMICS_COLUMNS)
    )


def portfolio_by_action(portfolio: DataFrame) -> DataFrame:
    return (
        portfolio.groupBy("recommended_action")
        .agg(
            F.count("session_id").alias("sessions"),
            round_to(F.sum("expected_net_value"), 2).alias("expected_net_value"),
        )
        .orderBy(F.desc("expected_net_value"), "recommended_action")
    )


def portfolio_totals(portfolio: DataFrame) -> DataFrame:
    return portfolio.agg(
        F.count("*").alias("selected_sessions"),
        round_to(F.sum("expected_net_value"), 2).alias("total_expected_net_value"),
        round_to(F.avg("expected_net_value"), 2).alias("average_expected_net_value"),
    )


# ------------------------------------------------------------------------- ROI
def _roi(net: Column, cost: Column) -> Column:
    return F.when(cost > 0, F.try_divide(net, cost) * 100).otherwise(0.0)


def intervention_roi(portfolio: DataFrame) -> DataFrame:
    """Portfolio rows with ``roi_pct``; 0 where nothing is spent."""
    return portfolio.withColumn(
        "roi_pct", _roi(F.col("expected_net_value"), F.col("intervention_cost"))
    )


def _roi_sums():
    return [
        F.sum("expected_recovery_value").alias("expected_recovery_value"),
        F.sum("intervention_cost").alias("intervention_cost"),
        F.sum("expected_net_value").alias("expected_net_value"),
    ]


def roi_totals(roi: DataFrame) -> DataFrame:
    """Portfolio sums and the overall ROI as ratio of the sums."""
    return roi.agg(*_roi_sums()).withColumn(
        "overall_roi_pct", _roi(F.col("expected_net_value"), F.col("intervention_cost"))
    )


def roi_by_action(roi: DataFrame) -> DataFrame:
    """Sums and ROI (ratio of sums) by action."""
    return (
        roi.groupBy("recommended_action")
        .agg(F.count("session_id").alias("sessions"), *_roi_sums())
        .withColumn(
            "roi_pct", _roi(F.col("expected_net_value"), F.col("intervention_cost"))
        )
        .orderBy(F.desc("expected_net_value"), "recommended_action")
    )


def top_roi(roi: DataFrame, limit: int = 10) -> DataFrame:
    return (
        roi.select(
            "portfolio_rank",
            "session_id",
            "recommended_action",
            "cart_value",
            "expected_recovery_value",
            "intervention_cost",
            "expected_net_value",
            "roi_pct",
        )
        .orderBy(F.desc("roi_pct"), "portfolio_rank")
        .limit(limit)
    )
