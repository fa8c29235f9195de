"""Session funnel, conversion and drop-off metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.functions.columns import distribution, is_event, share, side_by_side, tally

# step -> (timestamp column, reached flag)
_STEP_COLUMNS = {
    "homepage_view": ("homepage_view_at", "reached_homepage"),
    "product_click": ("product_click_at", "reached_product_click"),
    "add_to_cart": ("add_to_cart_at", "reached_cart"),
    "purchase_complete": ("purchase_complete_at", "reached_purchase"),
}


def _funnel_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_name").isin(*S.FUNNEL_STEPS))


def first_step_events(events: DataFrame) -> DataFrame:
    """The first event of each funnel type in each session, by (time, id).

    A minimum per (session, type), so partial aggregation reduces a hot
    session before the shuffle; no ranking window.
    """
    first = F.min(F.struct("event_timestamp", "event_id", "user_id")).alias("first")
    return (
        _funnel_events(events)
        .groupBy("session_id", "event_name")
        .agg(first)
        .select(
            "session_id",
            "first.user_id",
            "event_name",
            "first.event_id",
            "first.event_timestamp",
        )
    )


def session_funnel(events: DataFrame) -> DataFrame:
    """First time of each step, reached flags and outcome per (session, user).

    All four firsts come from one aggregate by session. Each step belongs to
    the user of its first event; a session shared by users yields one row per
    owner.
    """
    stamp = F.struct("event_timestamp", "event_id", "user_id")
    return owners_of_steps(
        _funnel_events(events)
        .groupBy("session_id")
        .agg(*[F.min(F.when(is_event(step), stamp)).alias(step) for step in S.FUNNEL_STEPS])
    )


def owners_of_steps(firsts: DataFrame) -> DataFrame:
    """Rows by (session, user) of sessions with the first event of each step, a struct
    (event_timestamp, event_id, user_id) or NULL, in a column named like the step."""
    reached_steps = F.filter(
        F.array(*[F.col(step) for step in S.FUNNEL_STEPS]), lambda s: s.isNotNull()
    )
    owners = F.array_distinct(F.transform(reached_steps, lambda s: s["user_id"]))
    per_owner = firsts.withColumn("user_id", F.explode(owners))
    times = [
        F.when(
            F.col(step).isNotNull() & F.col(f"{step}.user_id").eqNullSafe(F.col("user_id")),
            F.col(f"{step}.event_timestamp"),
        ).alias(at)
        for step, (at, _) in _STEP_COLUMNS.items()
    ]
    return with_reached_flags(per_owner.select("session_id", "user_id", *times))


def with_reached_flags(steps: DataFrame) -> DataFrame:
    """Add the reached flags and the outcome: the furthest step by priority,
    whatever order the steps happened in."""
    outcome = (
        F.when(F.col("reached_purchase"), "purchased")
        .when(F.col("reached_cart"), "cart_abandoned")
        .when(F.col("reached_product_click"), "product_abandoned")
        .otherwise("homepage_abandoned")
    )
    flags = [F.col(at).isNotNull().alias(hit) for at, hit in _STEP_COLUMNS.values()]
    return steps.select("*", *flags).withColumn("funnel_outcome", outcome)


def _unpivot(totals: DataFrame, steps: dict[str, str], *names: str) -> DataFrame:
    """One row of counts to one row per step: (step_order, label, sessions)."""
    order, label, value = names
    rows = [
        F.struct(
            F.lit(i).alias(order), F.lit(step).alias(label), F.col(column).alias(value)
        )
        for i, (step, column) in enumerate(steps.items(), start=1)
    ]
    return totals.select(F.inline(F.array(*rows)))


def funnel_metrics(funnel: DataFrame) -> DataFrame:
    """Sessions, conversion and drop-off of the four funnel steps.

    The ordered window runs over the four step rows only.
    """
    flags = {step: hit for step, (_, hit) in _STEP_COLUMNS.items()}
    totals = funnel.agg(*[tally(F.col(hit)).alias(hit) for hit in flags.values()])
    by_step = Window.orderBy("step_order")
    steps = (
        _unpivot(totals, flags, "step_order", "funnel_step", "sessions")
        .withColumn("before", F.lag("sessions").over(by_step))
        .withColumn("entry", F.first("sessions").over(by_step))
    )
    now, before = F.col("sessions"), F.col("before")
    is_first = before.isNull()
    return steps.select(
        "step_order",
        "funnel_step",
        "sessions",
        share(now, F.col("entry")).alias("absolute_conversion_pct"),
        share(now, before).alias("step_conversion_pct"),
        F.when(is_first, F.lit(0)).otherwise(before - now).cast("long").alias(
            "step_dropoff_sessions"
        ),
        F.when(is_first, F.lit(0.0)).otherwise(share(before - now, before)).alias(
            "step_dropoff_pct"
        ),
    ).orderBy("step_order")


def funnel_outcomes(funnel: DataFrame) -> DataFrame:
    return distribution(funnel, "funnel_outcome").orderBy(F.desc("sessions"), "funnel_outcome")


def funnel_ordering(funnel: DataFrame) -> DataFrame:
    """Sessions whose later step happened before the earlier one."""

    def inverted(earlier: str, later: str):
        return tally(F.col(later) < F.col(earlier))

    return funnel.agg(
        inverted("homepage_view_at", "product_click_at").alias("invalid_product_click_order"),
        inverted("product_click_at", "add_to_cart_at").alias("invalid_cart_order"),
        inverted("add_to_cart_at", "purchase_complete_at").alias("invalid_purchase_order"),
    )


def purchase_consistency(events: DataFrame, funnel: DataFrame) -> DataFrame:
    return side_by_side(
        events.where(is_event("purchase_complete")).agg(
            F.count("*").alias("raw_purchase_events")
        ),
        funnel.agg(tally(F.col("reached_purchase")).alias("funnel_purchase_sessions")),
    )


def checkout_funnel(events: DataFrame) -> DataFrame:
    """Sessions reaching view, cart, checkout and purchase, as % of the first."""
    steps = {step: f"hit_{step}" for step in S.CHECKOUT_FUNNEL_STEPS}
    per_session = (
        events.where(F.col("event_name").isin(*S.CHECKOUT_FUNNEL_STEPS))
        .groupBy("session_id")
        .agg(*[F.bool_or(is_event(step)).alias(hit) for step, hit in steps.items()])
    )
    totals = per_session.agg(*[tally(F.col(hit)).alias(hit) for hit in steps.values()])
    entry = F.first("sessions").over(Window.orderBy("step_order"))
    return (
        _unpivot(totals, steps, "step_order", "funnel_step", "sessions")
        .withColumn("conversion_from_product_pct", share(F.col("sessions"), entry))
        .orderBy("step_order")
    )
