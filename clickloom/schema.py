"""Event contract and the fixed values every operator shares."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Names, thresholds and assumptions of the data contract. Results depend on
# them, so they are stated once, here.

EVENT_NAMES = (
    "session_start",
    "homepage_view",
    "search",
    "product_view",
    "product_click",
    "wishlist_add",
    "add_to_cart",
    "cart_view",
    "remove_from_cart",
    "checkout_start",
    "payment_attempt",
    "payment_error",
    "purchase_complete",
    "session_end",
)

VARIANTS = ("control", "treatment")

REQUIRED_EVENT_COLUMNS = (
    "event_id",
    "user_id",
    "session_id",
    "event_timestamp",
    "event_name",
    "experiment_id",
    "variant",
)

FUNNEL_STEPS = ("homepage_view", "product_click", "add_to_cart", "purchase_complete")
CHECKOUT_FUNNEL_STEPS = (
    "product_view",
    "add_to_cart",
    "checkout_start",
    "purchase_complete",
)

DEFAULT_EXPERIMENT_ID = "EXP-001"

NUMERIC_FEATURES = (
    "total_actions_so_far",
    "unique_event_types",
    "product_views",
    "add_to_cart_actions",
    "cart_views",
    "checkout_starts",
    "payment_attempts",
    "payment_errors",
    "observed_session_duration_minutes",
)
CATEGORICAL_FEATURES = ("device_type", "traffic_source")
FEATURE_COLUMNS = NUMERIC_FEATURES + CATEGORICAL_FEATURES
TARGET_COLUMN = "churned"
LEAKAGE_COLUMNS = (
    "purchased_1",
    "purchase_timestamp",
    "session_end_timestamp",
    "future_purchase",
)

RISK_BANDS = ("low", "medium", "high", "critical")
RISK_CUTS = (0.50, 0.70, 0.85)

# action -> (priority, recovery_probability, intervention_cost)
ACTIONS = {
    "payment_recovery": ("critical", 0.35, 8.0),
    "checkout_recovery": ("high", 0.20, 5.0),
    "cart_recovery": ("high", 0.12, 3.0),
    "monitor": ("medium", 0.0, 0.0),
    "no_action": ("low", 0.0, 0.0),
}
RECOVERY_ACTIONS = ("payment_recovery", "checkout_recovery", "cart_recovery")
PRIORITIES = ("critical", "high", "medium", "low")
DEFAULT_CAPACITY = 500

THRESHOLDS = (0.50, 0.60, 0.70, 0.75, 0.80, 0.90)
HIGH_RISK_THRESHOLD = 0.75
SUMMARY_PERCENTILES = (0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95)
CORRELATION_CUT = 0.80

WAREHOUSE_TABLES = (
    "events",
    "analytics_session_funnel",
    "analytics_funnel_metrics",
    "analytics_velocity_metrics",
    "analytics_experiment_population",
    "analytics_churn_feature_dataset",
    "analytics_churn_risk_scores",
    "analytics_intervention_candidates",
    "analytics_intervention_economics",
    "analytics_intervention_portfolio",
    "analytics_intervention_roi",
)

# ------------------------------------------------------------------- schemas

EVENT_PROPERTIES = T.StructType(
    [
        T.StructField("persona", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("idle_before_cart_view_seconds", T.LongType()),
    ]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("traffic_source", T.StringType()),
        T.StructField("campaign", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("cart_value", T.DoubleType()),
        T.StructField("experiment_id", T.StringType()),
        T.StructField("variant", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("error_code", T.StringType()),
        T.StructField("event_properties", EVENT_PROPERTIES),
    ]
)

FEATURE_TABLE_COLUMNS = (
    "user_id",
    "session_id",
    "observation_timestamp",
    "purchased",
    "total_actions_so_far",
    "unique_event_types",
    "product_views",
    "add_to_cart_actions",
    "cart_views",
    "checkout_starts",
    "payment_attempts",
    "payment_errors",
    "has_cart",
    "reached_checkout",
    "session_start_timestamp",
    "latest_event_timestamp",
    "observed_session_duration_minutes",
    "device_type",
    "traffic_source",
    "churned",
)
