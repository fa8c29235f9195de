"""Adapter from the generic test ``events`` table to the event contract.

The test table has no sessions, variants or devices. Everything below is
derived from its rows with built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.functions.columns import seconds_between, time_bucket
from clickloom.operators.experiments import assigned_variant

SESSION_GAP_SECONDS = 43_200
SLOT_SECONDS = 3_600

# Fixed values of the adapter.
TRAFFIC_SOURCES = ("organic", "paid_search", "social", "email", "direct")
PERSONAS = (
    "window_shopper",
    "high_intent_buyer",
    "price_sensitive",
    "mobile_friction",
    "returning_buyer",
    "high_risk_cart",
)
CART_EVENTS = (
    "add_to_cart",
    "cart_view",
    "checkout_start",
    "payment_attempt",
    "payment_error",
    "purchase_complete",
)


def sessions_by_gap(
    raw: DataFrame,
    gap_seconds: int = SESSION_GAP_SECONDS,
    slot_seconds: int = SLOT_SECONDS,
) -> DataFrame:
    """One row per (user_id, slot) with the number of its session.

    Two events in one slot are never further apart than the gap (a slot is no
    longer than it), so a slot lies in exactly one session. Whether a session
    starts is therefore decided on slot ranges: events are pre-aggregated, and
    the window sees at most one row per user and slot.
    """
    if slot_seconds > gap_seconds:
        raise ValueError("a slot must not be longer than the session gap")
    by_user = Window.partitionBy("user_id").orderBy("slot")
    silence = seconds_between(F.lag("last_ts").over(by_user), F.col("first_ts"))
    return (
        # stated here so that every use of the sessions plans the same shuffle
        # (a join on the keys would add the filter to its own copy only)
        raw.withColumn("slot", time_bucket(F.col("ts"), slot_seconds))
        .where(F.col("user_id").isNotNull() & F.col("slot").isNotNull())
        .groupBy("user_id", "slot")
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        .withColumn(
            "opens",
            F.when(silence.isNull() | (silence > gap_seconds), 1).otherwise(0),
        )
        .withColumn("session_no", F.sum("opens").over(by_user))
        .select("user_id", "slot", "first_ts", "last_ts", "session_no")
    )


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _event_name() -> Column:
    kind, k = F.col("event_type"), F.col("k")
    return (
        F.when((kind == "view") & (k % 2 == 0), "homepage_view")
        .when(kind == "view", "product_view")
        .when((kind == "click") & (k % 4 < 2), "product_click")
        .when((kind == "click") & (k % 4 == 2), "search")
        .when(kind == "click", "wishlist_add")
        .when((kind == "signup") & (k % 4 < 2), "add_to_cart")
        .when((kind == "signup") & (k % 4 == 2), "cart_view")
        .when(kind == "signup", "checkout_start")
        .when((kind == "error") & (k % 2 == 0), "payment_attempt")
        .when(kind == "error", "payment_error")
        .when(kind == "purchase", "purchase_complete")
    )


def canonical_events(raw: DataFrame) -> DataFrame:
    """Events of the test table in the event contract, boundary rows included."""
    sessions = sessions_by_gap(raw)
    session_id = F.concat(
        F.col("user_id").cast("string"), F.lit("-"), F.col("session_no").cast("string")
    )
    placed = raw.withColumn("slot", time_bucket(F.col("ts"), SLOT_SECONDS))
    # Without user or time an event has no session; it needs no join to stay.
    loose = placed.where(F.col("user_id").isNull() | F.col("slot").isNull()).withColumn(
        "session_no", F.lit(None).cast("long")
    )
    body = (
        placed.join(sessions.select("user_id", "slot", "session_no"), ["user_id", "slot"])
        .unionByName(loose)
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        .select(
            F.col("event_id").cast("string").alias("event_id"),
            "user_id",
            session_id.alias("session_id"),
            F.col("ts").alias("event_timestamp"),
            _event_name().alias("event_name"),
            F.col("value"),
            (F.col("k") * 10).cast("long").alias("idle"),
        )
    )
    borders = (
        sessions.groupBy("user_id", "session_no")
        .agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
        .withColumn("session_id", session_id)
        .select(
            "user_id",
            "session_id",
            F.inline(
                F.array(
                    F.struct(
                        F.concat(F.lit("S-"), F.col("session_id")).alias("event_id"),
                        F.expr("first_ts - interval 1 second").alias("event_timestamp"),
                        F.lit("session_start").alias("event_name"),
                    ),
                    F.struct(
                        F.concat(F.lit("E-"), F.col("session_id")).alias("event_id"),
                        F.expr("last_ts + interval 1 second").alias("event_timestamp"),
                        F.lit("session_end").alias("event_name"),
                    ),
                )
            ),
        )
        .withColumn("value", F.lit(None).cast("double"))
        .withColumn("idle", F.lit(None).cast("long"))
    )
    user = F.col("user_id")
    name = F.col("event_name")
    derived = {
        "event_id": F.col("event_id"),
        "user_id": user.cast("string"),
        "session_id": F.col("session_id"),
        "event_timestamp": F.col("event_timestamp"),
        "event_name": name,
        "device_type": F.when(user % 2 == 0, "mobile").otherwise("desktop"),
        "traffic_source": _pick(TRAFFIC_SOURCES, user % 5),
        "cart_value": F.when(name.isin(*CART_EVENTS), F.col("value")),
        "experiment_id": F.lit(S.DEFAULT_EXPERIMENT_ID),
        "variant": assigned_variant(user.cast("string"), F.lit(S.DEFAULT_EXPERIMENT_ID)),
        "event_properties": F.struct(
            F.when(name == "session_start", _pick(PERSONAS, user % 6)).alias("persona"),
            F.lit(None).cast("string").alias("query"),
            F.when(name == "cart_view", F.col("idle")).alias("idle_before_cart_view_seconds"),
        ),
    }
    return body.unionByName(borders).select(
        *[
            derived.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in S.EVENT_SCHEMA.fields
        ]
    )


def read_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
