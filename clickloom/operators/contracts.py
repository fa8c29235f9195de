"""Contracts between the tables: counters and a pass flag, one row each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.functions.columns import any_null, side_by_side, tally

TOLERANCE = 1e-6
SESSION = "session_id"


class ContractError(ValueError):
    """A table broke its contract."""


def require(report: DataFrame, message: str, flag: str = "passed") -> DataFrame:
    """Raise ContractError unless the one-row report passed; return the report."""
    row = report.first()
    if row is None or not row[flag]:
        raise ContractError(f"{message}: {row.asDict() if row else 'no report'}")
    return report


def _all_zero(*names: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n) == 0 for n in names])


def reconcile(left: DataFrame, right: DataFrame, key: str = SESSION) -> DataFrame:
    """Row, key and membership counters of two tables, in one shuffle.

    Keys of both tables are stacked and counted per key; partial aggregation
    folds a repeated key first, and nothing is joined. A NULL key matches
    nothing. ``missing_right`` counts left rows without a right key,
    ``missing_left`` the reverse.
    """
    sides = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = sides.groupBy(key).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    no_key = F.col(key).isNull()

    def rows(column: str, only: Column | None = None) -> Column:
        value = F.col(column) if only is None else F.when(only, F.col(column))
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    return per_key.agg(
        rows("l").alias("left_rows"),
        rows("r").alias("right_rows"),
        tally((F.col("l") > 0) & ~no_key).alias("left_keys"),
        tally((F.col("r") > 0) & ~no_key).alias("right_keys"),
        tally(F.col("l") > 1).alias("left_duplicates"),
        tally(F.col("r") > 1).alias("right_duplicates"),
        rows("l", no_key | (F.col("r") == 0)).alias("missing_right"),
        rows("r", no_key | (F.col("l") == 0)).alias("missing_left"),
    )


def session_reconciliation(features: DataFrame, scores: DataFrame) -> DataFrame:
    """Feature sessions without a score, and scored sessions without features."""
    return reconcile(features, scores).select(
        F.col("missing_right").alias("feature_sessions_missing_scores"),
        F.col("missing_left").alias("unexpected_scored_sessions"),
    )


# -------------------------------------------------------------- feature dataset
def ml_integrity(features: DataFrame) -> DataFrame:
    """Duplicate sessions, invalid labels, labels contradicting the outcome."""
    label, bought = F.col("churned"), F.col("purchased")
    per_session = features.groupBy(SESSION).agg(
        F.count("*").alias("n"),
        tally(label.isNull() | ~label.isin(0, 1)).alias("bad"),
        tally(((bought == 1) & (label != 0)) | ((bought == 0) & (label != 1))).alias("torn"),
    )
    report = per_session.agg(
        F.sum("n").alias("total_rows"),
        F.count(SESSION).alias("distinct_sessions"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_labels"),
        F.coalesce(F.sum("torn"), F.lit(0)).alias("inconsistent_labels"),
    ).withColumn("duplicate_sessions", F.col("total_rows") - F.col("distinct_sessions"))
    return report.withColumn(
        "passed", _all_zero("duplicate_sessions", "invalid_labels", "inconsistent_labels")
    )


def ml_schema_contract(features: DataFrame) -> DataFrame:
    """Leakage columns, outcome columns and required columns, from the schema."""
    names = set(features.columns)
    leaked = sorted(names & set(S.LEAKAGE_COLUMNS))
    outcomes = {n for n in names if n.startswith(("purchased", "churned"))}
    needed = set(S.FEATURE_TABLE_COLUMNS) - {
        "session_start_timestamp",
        "latest_event_timestamp",
    }
    missing = sorted(needed - names)
    exact = outcomes == {"purchased", "churned"}
    row = (len(leaked), ",".join(sorted(outcomes)), exact, len(missing), ",".join(missing))
    return features.sparkSession.createDataFrame(
        [(*row, not leaked and exact and not missing)],
        "forbidden_columns int, outcome_columns string, outcome_columns_exact boolean, "
        "missing_columns int, missing_names string, passed boolean",
    )


# ------------------------------------------------------------------ risk scores
def score_contract(features: DataFrame, scores: DataFrame) -> DataFrame:
    score = F.col("churn_risk_score")
    values = scores.agg(
        tally(any_null("churn_probability", "churn_risk_score", "risk_band")).alias(
            "missing_scores"
        ),
        F.min(score).alias("minimum_risk_score"),
        F.max(score).alias("maximum_risk_score"),
        tally((score < 0) | (score > 100)).alias("out_of_range_scores"),
        tally(~F.col("risk_band").isin(*S.RISK_BANDS)).alias("invalid_risk_bands"),
    )
    keys = reconcile(features, scores).select(
        F.col("left_rows").alias("feature_dataset_rows"),
        F.col("right_rows").alias("scored_rows"),
        F.col("right_keys").alias("distinct_scored_sessions"),
        F.col("right_duplicates").alias("duplicate_sessions"),
        F.col("missing_right").alias("feature_sessions_missing_scores"),
        F.col("missing_left").alias("unexpected_scored_sessions"),
    )
    return side_by_side(keys, values).withColumn(
        "passed",
        (F.col("feature_dataset_rows") == F.col("scored_rows"))
        & (F.col("scored_rows") == F.col("distinct_scored_sessions"))
        & _all_zero(
            "duplicate_sessions",
            "missing_scores",
            "out_of_range_scores",
            "invalid_risk_bands",
            "feature_sessions_missing_scores",
            "unexpected_scored_sessions",
        ),
    )


# ------------------------------------------------------------------- candidates
def candidate_contract(scores: DataFrame, candidates: DataFrame) -> DataFrame:
    action, priority = F.col("recommended_action"), F.col("intervention_priority")
    mismatch = reduce(
        lambda a, b: a | b,
        [(action == name) & (priority != entry[0]) for name, entry in S.ACTIONS.items()],
    )
    values = candidates.agg(
        tally(any_null("recommended_action", "intervention_priority")).alias("missing_values"),
        tally(~action.isin(*S.ACTIONS)).alias("invalid_actions"),
        tally(~priority.isin(*S.PRIORITIES)).alias("invalid_priorities"),
        tally(mismatch).alias("inconsistent_actions"),
    )
    keys = reconcile(scores, candidates).select(
        F.col("left_rows").alias("scored_sessions"),
        F.col("right_rows").alias("intervention_sessions"),
        F.col("right_keys").alias("distinct_intervention_sessions"),
        F.col("right_duplicates").alias("duplicate_sessions"),
        F.col("missing_right").alias("missing_interventions"),
        F.col("missing_left").alias("unexpected_interventions"),
    )
    return side_by_side(keys, values).withColumn(
        "passed",
        (F.col("scored_sessions") == F.col("intervention_sessions"))
        & (F.col("intervention_sessions") == F.col("distinct_intervention_sessions"))
        & _all_zero(
            "duplicate_sessions",
            "missing_values",
            "invalid_actions",
            "invalid_priorities",
            "inconsistent_actions",
            "missing_interventions",
            "unexpected_interventions",
        ),
    )


# -------------------------------------------------------------------------- ROI
def roi_contract(portfolio: DataFrame, roi: DataFrame) -> DataFrame:
    """Reconciliation and formulas of the ROI table.

    The total is compared with a tolerance relative to its size: the order of
    a distributed sum is not fixed.
    """
    recovery, cost = F.col("expected_recovery_value"), F.col("intervention_cost")
    net, pct = F.col("expected_net_value"), F.col("roi_pct")

    def blank(column: Column) -> Column:
        return F.when(column.isNull() | F.isnan(column), 1).otherwise(0)

    difference = F.abs(F.sum(recovery) - F.sum(cost) - F.sum(net))
    values = roi.agg(
        F.coalesce(F.sum(blank(recovery) + blank(cost) + blank(net) + blank(pct)), F.lit(0)).alias(
            "missing_values"
        ),
        tally(recovery < 0).alias("negative_recovery_values"),
        tally(cost < 0).alias("negative_costs"),
        tally(F.abs(recovery - cost - net) > TOLERANCE).alias("invalid_net_value_rows"),
        tally((cost == 0) & (F.abs(pct) > TOLERANCE)).alias("invalid_zero_cost_roi_rows"),
        tally(
            (cost > 0) & (F.abs(F.try_divide(net, cost) * 100 - pct) > TOLERANCE)
        ).alias("invalid_roi_rows"),
        F.coalesce(
            difference <= TOLERANCE * F.greatest(F.lit(1.0), F.sum(F.abs(recovery))),
            F.lit(True),
        ).alias("totals_match"),
    )
    keys = reconcile(portfolio, roi).select(
        F.col("left_rows").alias("portfolio_rows"),
        F.col("right_rows").alias("roi_rows"),
        (F.col("right_rows") - F.col("left_rows")).alias("row_difference"),
        F.col("right_duplicates").alias("duplicate_sessions"),
        F.col("missing_right").alias("missing_from_roi"),
        F.col("missing_left").alias("unexpected_roi_sessions"),
    )
    return side_by_side(keys, values).withColumn(
        "passed",
        F.col("totals_match")
        & _all_zero(
            "row_difference",
            "duplicate_sessions",
            "missing_from_roi",
            "unexpected_roi_sessions",
            "missing_values",
            "negative_recovery_values",
            "negative_costs",
            "invalid_net_value_rows",
            "invalid_zero_cost_roi_rows",
            "invalid_roi_rows",
        ),
    )


# ------------------------------------------------------------------- end to end
_SESSION_TABLES = ("features", "scores", "candidates", "economics", "portfolio", "roi")

# (table, table it must be contained in)
_CONTAINED = (
    ("features", "scores"),
    ("scores", "features"),
    ("candidates", "scores"),
    ("candidates", "economics"),
    ("portfolio", "economics"),
    ("portfolio", "roi"),
    ("roi", "portfolio"),
)


def warehouse_contract(
    features: DataFrame,
    scores: DataFrame,
    candidates: DataFrame,
    economics: DataFrame,
    portfolio: DataFrame,
    roi: DataFrame,
    capacity: int = S.DEFAULT_CAPACITY,
) -> DataFrame:
    """One row over the six session tables: rows, duplicates, sessions without
    a counterpart, blank actions, capacity, and the chain of equal counts.

    All keys are stacked once with a counter per table; one shuffle by session
    answers every duplicate and membership check.
    """
    tables = dict(
        zip(_SESSION_TABLES, (features, scores, candidates, economics, portfolio, roi))
    )
    stacked = reduce(
        DataFrame.unionByName,
        [
            df.select(
                SESSION,
                *[F.lit(int(name == other)).alias(other) for other in _SESSION_TABLES],
            )
            for name, df in tables.items()
        ],
    )
    per_session = stacked.groupBy(SESSION).agg(
        *[F.sum(name).alias(name) for name in _SESSION_TABLES]
    )
    no_key = F.col(SESSION).isNull()

    def lonely(table: str, other: str) -> Column:
        alone = no_key | (F.col(other) == 0)
        return F.coalesce(F.sum(F.when(alone, F.col(table))), F.lit(0)).cast("long")

    counters = per_session.agg(
        *[
            F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(f"{n}_sessions")
            for n in _SESSION_TABLES
        ],
        *[tally(F.col(n) > 1).alias(f"duplicate_{n}_sessions") for n in _SESSION_TABLES],
        *[lonely(t, other).alias(f"{t}_missing_{other}") for t, other in _CONTAINED],
    )
    action = F.col("recommended_action")
    blanks = candidates.agg(
        tally(action.isNull() | (F.trim(action) == "")).alias("missing_recommended_actions")
    )

    def rows(name: str) -> Column:
        return F.col(f"{name}_sessions")

    return (
        side_by_side(counters, blanks)
        .withColumn("capacity_respected", rows("portfolio") <= capacity)
        .withColumn(
            "counts_chain",
            (rows("features") == rows("scores"))
            & (rows("scores") == rows("candidates"))
            & (rows("candidates") == rows("economics"))
            & (rows("portfolio") == rows("roi"))
            & (rows("portfolio") <= rows("economics")),
        )
        .withColumn(
            "passed",
            (rows("features") > 0)
            & F.col("capacity_respected")
            & F.col("counts_chain")
            & _all_zero(
                *[f"duplicate_{n}_sessions" for n in _SESSION_TABLES],
                *[f"{t}_missing_{other}" for t, other in _CONTAINED],
                "missing_recommended_actions",
            ),
        )
    )
