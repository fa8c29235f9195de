"""Event velocity, cart idle time, personas and payment friction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import is_event, minutes_between, round_to, share, tally
from clickloom.functions.segments import SEGMENT_SECONDS, kept_segment, with_neighbours


def event_context(
    events: DataFrame, hot: Sequence[str] | None = None, seconds: int = SEGMENT_SECONDS
) -> DataFrame:
    """Each event with name and time of its neighbours in the session.

    ``hot`` lists session ids to split by time; None finds them in one pass.
    """
    rows = with_neighbours(
        events.select(
            "session_id", "user_id", "event_id", "event_name", "event_timestamp", *kept_segment(events)
        ),
        "session_id",
        "event_timestamp",
        "event_id",
        ["event_timestamp", "event_name"],
        hot,
        seconds,
    )
    return rows.select(
        "session_id",
        "user_id",
        "event_id",
        "event_name",
        "event_timestamp",
        F.col("previous.event_timestamp").alias("previous_event_timestamp"),
        F.col("previous.event_name").alias("previous_event_name"),
        F.col("following.event_timestamp").alias("next_event_timestamp"),
        F.col("following.event_name").alias("next_event_name"),
    )


def event_velocity(
    events: DataFrame, hot: Sequence[str] | None = None, seconds: int = SEGMENT_SECONDS
) -> DataFrame:
    """Minutes to the neighbouring events, each rounded to 2 places."""
    now = F.col("event_timestamp")
    since = minutes_between(F.col("previous_event_timestamp"), now)
    until = minutes_between(now, F.col("next_event_timestamp"))
    return event_context(events, hot, seconds).select(
        "session_id",
        "user_id",
        "event_name",
        "event_timestamp",
        "previous_event_name",
        "next_event_name",
        round_to(since, 2).alias("minutes_since_previous_event"),
        round_to(until, 2).alias("minutes_to_next_event"),
    )


def _mean(column: str) -> Column:
    """Mean of values with at most 2 places, from their sum in hundredths.

    Integer sums do not depend on the order in which partitions arrive, so a
    mean on a rounding border rounds the same way on every run.
    """
    hundredths = F.round(F.col(column) * 100).cast("long")
    return round_to(F.try_divide(F.sum(hundredths), F.count(column) * 100), 2)


def velocity_metrics(
    events: DataFrame, hot: Sequence[str] | None = None, seconds: int = SEGMENT_SECONDS
) -> DataFrame:
    """Gap statistics and duration per (session, user)."""
    at, since = F.col("event_timestamp"), "minutes_since_previous_event"
    return (
        event_velocity(events, hot, seconds)
        .groupBy("session_id", "user_id")
        .agg(
            F.count("*").alias("total_events"),
            round_to(minutes_between(F.min(at), F.max(at)), 2).alias("session_duration_minutes"),
            _mean(since).alias("average_event_gap_minutes"),
            F.max(since).alias("maximum_event_gap_minutes"),
            _mean("minutes_to_next_event").alias("average_next_event_gap_minutes"),
        )
    )


_AVERAGES = {
    "avg_session_duration_minutes": "session_duration_minutes",
    "avg_event_gap_minutes": "average_event_gap_minutes",
    "avg_max_event_gap_minutes": "maximum_event_gap_minutes",
    "avg_events_per_session": "total_events",
}


def _velocity_averages():
    return [F.count("*").alias("sessions")] + [
        _mean(source).alias(name) for name, source in _AVERAGES.items()
    ]


def velocity_overview(velocity: DataFrame) -> DataFrame:
    return velocity.agg(*_velocity_averages())


def outcome_velocity(funnel: DataFrame, velocity: DataFrame) -> DataFrame:
    """Velocity of purchased against cart-abandoned sessions.

    Both sides have one row per (session, user), so no key is hot.
    """
    return (
        funnel.where(F.col("funnel_outcome").isin("purchased", "cart_abandoned"))
        .select("session_id", "user_id", "funnel_outcome")
        .join(velocity, ["session_id", "user_id"])
        .groupBy("funnel_outcome")
        .agg(*_velocity_averages())
        .orderBy("funnel_outcome")
    )


def _idle_seconds():
    return F.col("event_properties.idle_before_cart_view_seconds")


def _persona():
    return F.col("event_properties.persona")


def cart_idle_events(events: DataFrame) -> DataFrame:
    """Cart idle time by persona over cart_view events.

    Both sides are reduced to one row per (session, user[, persona]) before
    the join; a session with several starts counts its views once per start,
    through a weight instead of row pairs.
    """
    starts = (
        events.where(is_event("session_start"))
        .groupBy("session_id", "user_id", _persona().alias("persona"))
        .agg(F.count("*").alias("weight"))
    )
    views = (
        events.where(is_event("cart_view") & _idle_seconds().isNotNull())
        .groupBy("session_id", "user_id")
        .agg(
            F.count("*").alias("views"),
            F.sum(_idle_seconds()).alias("idle_sum"),
            F.max(_idle_seconds()).alias("idle_max"),
        )
    )
    weight, n = F.col("weight"), F.sum(F.col("views") * F.col("weight"))
    average = F.sum(F.col("idle_sum") * weight).cast("double") / n.cast("double")
    return (
        views.join(starts, ["session_id", "user_id"])
        .groupBy("persona")
        .agg(
            n.alias("cart_view_events"),
            round_to(average, 2).alias("avg_idle_seconds"),
            F.max("idle_max").cast("double").alias("max_idle_seconds"),
        )
        .orderBy(F.desc("avg_idle_seconds"), "persona")
    )


def cart_idle_sessions(events: DataFrame) -> DataFrame:
    """Longest cart idle time of each session, averaged by persona."""
    return (
        events.where(F.col("event_name").isin("session_start", "cart_view"))
        .groupBy("session_id")
        .agg(
            F.max(F.when(is_event("session_start"), _persona())).alias("persona"),
            F.max(F.when(is_event("cart_view"), _idle_seconds())).alias("idle_seconds"),
        )
        .where(F.col("idle_seconds").isNotNull())
        .groupBy("persona")
        .agg(
            round_to(F.avg("idle_seconds"), 2).alias("average_cart_idle_seconds"),
            F.max("idle_seconds").cast("double").alias("maximum_cart_idle_seconds"),
        )
        .orderBy(F.desc("average_cart_idle_seconds"), "persona")
    )


def persona_distribution(events: DataFrame) -> DataFrame:
    """Distinct users and session starts by persona."""
    return (
        events.where(is_event("session_start"))
        .groupBy(_persona().alias("persona"), "user_id")
        .agg(F.count("*").alias("starts"))
        .groupBy("persona")
        .agg(F.count("user_id").alias("users"), F.sum("starts").alias("sessions"))
        .orderBy(F.desc("users"), "persona")
    )


def payment_friction(events: DataFrame) -> DataFrame:
    """Payment attempts, errors and error rate by variant."""
    return (
        events.groupBy("variant")
        .agg(
            tally(is_event("payment_attempt")).alias("payment_attempts"),
            tally(is_event("payment_error")).alias("payment_errors"),
        )
        .withColumn(
            "payment_error_rate_pct",
            share(F.col("payment_errors"), F.col("payment_attempts"), 3),
        )
        .orderBy("variant")
    )
