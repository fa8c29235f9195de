"""Point-in-time safe session features and their label.

A session is observed up to its last event before the purchase. Nothing at or
after the purchase may enter a feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.functions.columns import (
    distribution,
    flag,
    is_event,
    minutes_between,
    round_to,
    share,
    tally,
)
from clickloom.functions.segments import (
    EVERY_KEY,
    SEGMENT,
    SEGMENT_SECONDS,
    cut_by_segment,
    hot_keys,
    is_hot,
    join_segments,
    kept_segment,
    segment_number,
    with_positions,
)

def ordered_events(
    events: DataFrame, hot: Sequence[str] | None = None, seconds: int = SEGMENT_SECONDS
) -> DataFrame:
    """Events with their position in the session and the session's length."""
    rows = events.select(
        "event_id",
        "user_id",
        "session_id",
        "event_timestamp",
        "event_name",
        "page",
        "device_type",
        "traffic_source",
        "category",
        "quantity",
        "price",
        "cart_value",
        F.col("event_properties.persona").alias("persona"),
        *kept_segment(events),
    )
    named = [c for c in rows.columns if c != SEGMENT]
    return with_positions(
        rows,
        "session_id",
        "event_timestamp",
        "event_id",
        "event_sequence",
        "total_session_events",
        hot,
        seconds,
    ).select(*named, "event_sequence", "total_session_events")


def session_outcomes(events: DataFrame) -> DataFrame:
    """Per session: purchased 0/1 and the time of the first purchase."""
    bought = is_event("purchase_complete")
    return events.groupBy("session_id").agg(
        F.max(flag(bought)).alias("purchased"),
        F.min(F.when(bought, F.col("event_timestamp"))).alias("purchase_timestamp"),
    )


def _is_extra() -> Column:
    """Rows that are no observation but count if they are before the cutoff."""
    return is_event("session_end") | F.col("event_name").isNull()


def _before_purchase(
    events: DataFrame, hot: Sequence[str] | None, seconds: int
) -> DataFrame:
    """Events strictly before the first purchase of their session.

    Adds ``purchase_timestamp`` (first purchase of the session) and
    ``known_cutoff``: the latest observation already certain without looking
    at single rows of other segments. Most sessions are one segment, so both
    come from a window over rows that are together anyway; a hot session takes
    them from a summary with one row per segment.
    """
    hot = hot_keys(events, "session_id") if hot is None else hot
    at, bought = F.col("event_timestamp"), is_event("purchase_complete")
    seen = F.when(~bought & ~_is_extra(), at)
    together = Window.partitionBy("session_id", SEGMENT)
    cut = cut_by_segment(
        events.where(F.col("session_id").isNotNull()), "session_id", "event_timestamp", hot, seconds
    )
    rows = cut.select(
        *cut.columns,
        F.min(F.when(bought, at)).over(together).alias("purchase_timestamp"),
        F.max(seen).over(together).alias("known_cutoff"),
    )
    bought_at, known = F.col("purchase_timestamp"), F.col("known_cutoff")
    if hot:
        rows = _with_hot_sessions(cut, rows, seen, hot, seconds)
    else:
        rows = rows.withColumn("known_cutoff", F.when(bought_at.isNull(), known))
    return rows.where(F.col("event_name").isNull() | ~bought).where(
        bought_at.isNull() | (at < bought_at)
    )


def _with_hot_sessions(
    cut: DataFrame, rows: DataFrame, seen: Column, hot: Sequence[str], seconds: int
) -> DataFrame:
    """Purchase time and known cutoff of hot sessions from their segments."""
    bought = F.when(is_event("purchase_complete"), F.col("event_timestamp"))
    whole_session = Window.partitionBy("session_id")  # one row per segment
    settled = F.col("_bought").isNull() | (F.col(SEGMENT) < segment_number("_bought", seconds))
    slots = (
        cut.where(is_hot("session_id", hot))
        .groupBy("session_id", SEGMENT)
        .agg(F.min(bought).alias("_bought_here"), F.max(seen).alias("_seen_here"))
        .withColumn("_bought", F.min("_bought_here").over(whole_session))
        .withColumn("_known", F.max(F.when(settled, F.col("_seen_here"))).over(whole_session))
        .select("session_id", SEGMENT, "_bought", "_known", F.lit(True).alias("_hot"))
    )
    local_purchase, local_seen = F.col("purchase_timestamp"), F.col("known_cutoff")
    return join_segments(rows, slots, "session_id").select(
        *cut.columns,
        F.when(F.col("_hot"), F.col("_bought")).otherwise(local_purchase).alias(
            "purchase_timestamp"
        ),
        F.when(F.col("_hot"), F.col("_known"))
        .otherwise(F.when(local_purchase.isNull(), local_seen))
        .alias("known_cutoff"),
    )


def observation_events(
    events: DataFrame, hot: Sequence[str] | None = None, seconds: int = SEGMENT_SECONDS
) -> DataFrame:
    """Events that may be observed: strictly before the first purchase, without
    the purchase and the session end themselves."""
    return (
        _before_purchase(events, hot, seconds)
        .where(~_is_extra())
        .select(*events.columns, "purchase_timestamp")
    )


_CUTOFF_FIELDS = ("observation_timestamp", "user_id", "device_type", "traffic_source")
_GROUP_KEYS = (
    "session_id",
    "user_id",
    "device_type",
    "traffic_source",
    "event_name",
    "contested_at",
)


def _user_key() -> Column:
    """The user behind a sign, or nothing for no user: no real id is special."""
    return F.coalesce(F.concat(F.lit("="), F.col("user_id")), F.lit(""))


def _user_of(key: str) -> Column:
    return F.when(F.col(key) != "", F.substring(key, 2, 2**31 - 1))


def _merged() -> list[Column]:
    return [
        F.sum("n").alias("n"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.max("purchase_timestamp").alias("purchase_timestamp"),
    ]


def _folded(events: DataFrame, hot: Sequence[str] | None, seconds: int) -> DataFrame:
    """Events before the purchase as counts per session, user, context and name.

    Grouping keys and fixed-width buffers only, so these are hash aggregates.
    The first fold stays on the (session, segment) partitioning of the rows;
    only its result moves, once, to (session, user), which also serves the
    join with the cutoff.

    A session_end (or unnamed event) counts only up to the cutoff. Those not
    later than the known cutoff fold like the others; where no purchase
    follows, the known cutoff is the cutoff and later ones drop out. The few
    between the known cutoff and the purchase stay apart by their time
    (``contested_at``) until the cutoff is known.
    """
    # A user that can be NULL would get a NOT NULL filter on the join branch of
    # churn_features only, and the two branches would shuffle separately; the
    # key of a user is never NULL.
    user = _user_key()
    at, known = F.col("event_timestamp"), F.col("known_cutoff")
    early = F.coalesce(at <= known, F.lit(False))
    open_end = F.col("purchase_timestamp").isNull()
    return (
        _before_purchase(events, hot, seconds)
        .where(at.isNotNull())  # without a time nothing lies before the cutoff
        .where(~_is_extra() | early | ~open_end)
        .withColumn("user_id", user)
        .withColumn("contested_at", F.when(_is_extra() & ~early, at))
        .groupBy(SEGMENT, *_GROUP_KEYS)
        .agg(
            F.count("*").alias("n"),
            F.min(at).alias("first_ts"),
            F.max(at).alias("last_ts"),
            F.max("purchase_timestamp").alias("purchase_timestamp"),
        )
        .repartition("session_id", "user_id")
        .groupBy(*_GROUP_KEYS)
        .agg(*_merged())
    )


def _cutoff(folded: DataFrame) -> DataFrame:
    """Last observation of each session; equal times are decided by user,
    device and source.

    The struct holds every folded column: none is pruned on this branch, so
    Spark reuses the shuffle of the folded rows instead of computing it again.
    """
    last = F.struct(
        F.col("last_ts").alias("observation_timestamp"),
        "user_id",
        "device_type",
        "traffic_source",
        *[c for c in folded.columns if c not in ("session_id", "last_ts", *_CUTOFF_FIELDS)],
    )
    return (
        folded.groupBy("session_id")
        .agg(F.max(F.when(~_is_extra(), last)).alias("last"))
        .where(F.col("last").isNotNull())
        .select("session_id", *[F.col(f"last.{f}") for f in _CUTOFF_FIELDS])
    )


def _with_last_seen(events: DataFrame) -> DataFrame:
    """Events up to the cutoff of sessions that fit into one task.

    Purchase time and cutoff (``last``) come from windows over the session, so
    the rows are shuffled and sorted once. Equal times are decided by user,
    device and source.
    """
    together = Window.partitionBy("session_id")
    at, bought = F.col("event_timestamp"), F.coalesce(is_event("purchase_complete"), F.lit(False))
    bought_at, last = F.col("purchase_timestamp"), F.col("last")
    place = F.struct(
        at.alias("observation_timestamp"), "user_id", "device_type", "traffic_source"
    )
    before = ~bought & (bought_at.isNull() | (at < bought_at))
    return (
        events.where(F.col("session_id").isNotNull() & at.isNotNull())
        .select(
            "session_id",
            _user_key().alias("user_id"),
            "device_type",
            "traffic_source",
            "event_name",
            "event_timestamp",
        )
        .withColumn("purchase_timestamp", F.min(F.when(bought, at)).over(together))
        .withColumn("last", F.max(F.when(before & ~_is_extra(), place)).over(together))
        .where(before & (at <= last["observation_timestamp"]))
    )


def _parts(
    events: DataFrame, hot: Sequence[str] | None
) -> tuple[DataFrame, DataFrame | None, Sequence[str]]:
    """Events of ordinary sessions, of hot ones (None if none is), hot keys."""
    hot = hot_keys(events, "session_id") if hot is None else hot
    if not hot:
        return events, None, hot
    return events.where(~is_hot("session_id", hot)), events.where(is_hot("session_id", hot)), hot


def observation_cutoff(
    events: DataFrame, hot: Sequence[str] | None = None, seconds: int = SEGMENT_SECONDS
) -> DataFrame:
    """Per session the last observable event: time, user, device and source."""
    ordinary, split, hot = _parts(events, hot)
    cutoff = (
        _with_last_seen(ordinary)
        .groupBy("session_id")
        .agg(F.max("last").alias("last"))
        .select("session_id", *[F.col(f"last.{f}") for f in _CUTOFF_FIELDS])
    )
    if split is not None:
        cutoff = cutoff.unionByName(_cutoff(_folded(split, hot, seconds)))
    return cutoff.withColumn("user_id", _user_of("user_id"))


def churn_features(
    events: DataFrame, hot: Sequence[str] | None = None, seconds: int = SEGMENT_SECONDS
) -> DataFrame:
    """One row per session with at least one observable event.

    Up to the cutoff lie exactly the observed events plus any session_end not
    later than it (every other event before the cutoff is before the purchase
    too). Rows of another user than the cutoff's do not count. Ordinary sessions
    need one shuffle, by session; hot ones are folded by segment first.
    """
    if hot is EVERY_KEY:
        return _features_by_name(_counts_of_split_sessions(events, hot, seconds))
    ordinary, split, hot = _parts(events, hot)
    features = _features_by_name(_counts_of_whole_sessions(ordinary))
    if split is None:
        return features
    return features.unionByName(_features_by_name(_counts_of_split_sessions(split, hot, seconds)))


_FEATURE_KEYS = ("session_id", *_CUTOFF_FIELDS)


def _counts_of_whole_sessions(events: DataFrame) -> DataFrame:
    """Counts per session, cutoff and event name from one shuffle."""
    at, last = F.col("event_timestamp"), F.col("last")
    return (
        _with_last_seen(events)
        .where(F.col("user_id") == last["user_id"])
        .groupBy("session_id", "last", "event_name")
        .agg(
            F.count("*").alias("n"),
            F.min(at).alias("first_ts"),
            F.max(at).alias("last_ts"),
            F.max("purchase_timestamp").alias("purchase_timestamp"),
        )
        .select(
            "session_id",
            *[last[f].alias(f) for f in _CUTOFF_FIELDS],
            "event_name",
            "n",
            "first_ts",
            "last_ts",
            "purchase_timestamp",
        )
    )


def _counts_of_split_sessions(events: DataFrame, hot: Sequence[str], seconds: int) -> DataFrame:
    """The same from events folded by segment."""
    folded = _folded(events, hot, seconds)
    cutoff = _cutoff(folded)
    contested = F.col("contested_at")
    return (
        folded.drop("device_type", "traffic_source")
        .join(cutoff, ["session_id", "user_id"])
        .where(contested.isNull() | (contested <= F.col("observation_timestamp")))
        .groupBy(*_FEATURE_KEYS, "event_name")
        .agg(*_merged())
    )


def _features_by_name(by_name: DataFrame) -> DataFrame:
    """Feature rows from counts per session, cutoff and event name."""

    def times(name: str) -> Column:
        return F.sum(F.when(is_event(name), F.col("n")).otherwise(0)).cast("long")

    start, latest = F.min("first_ts"), F.max("last_ts")
    purchased = flag(F.max("purchase_timestamp").isNotNull())
    return (
        by_name.groupBy(*_FEATURE_KEYS)
        .agg(
            purchased.alias("purchased"),
            F.sum("n").alias("total_actions_so_far"),
            F.count("event_name").alias("unique_event_types"),
            times("product_view").alias("product_views"),
            times("add_to_cart").alias("add_to_cart_actions"),
            times("cart_view").alias("cart_views"),
            times("checkout_start").alias("checkout_starts"),
            times("payment_attempt").alias("payment_attempts"),
            times("payment_error").alias("payment_errors"),
            F.max(flag(is_event("add_to_cart"))).alias("has_cart"),
            F.max(flag(is_event("checkout_start"))).alias("reached_checkout"),
            start.alias("session_start_timestamp"),
            latest.alias("latest_event_timestamp"),
            round_to(minutes_between(start, latest), 4).alias(
                "observed_session_duration_minutes"
            ),
            (1 - purchased).alias("churned"),
        )
        .withColumn("user_id", _user_of("user_id"))
        .where(F.col("user_id").isNotNull())
        .select(*S.FEATURE_TABLE_COLUMNS)
    )


# --------------------------------------------------------------------- reports
def churn_summary(features: DataFrame) -> DataFrame:
    """Sessions, users, churned and converted sessions, churn rate.

    Folded to users first, so the distinct count runs over users.
    """
    per_user = features.groupBy("user_id").agg(
        F.count("*").alias("n"), F.sum("churned").alias("churned"), F.count("churned").alias("k")
    )
    return per_user.agg(
        F.sum("n").alias("total_sessions"),
        F.count("user_id").alias("total_users"),
        F.sum("churned").alias("churned_sessions"),
        (F.sum("k") - F.sum("churned")).alias("converted_sessions"),
        share(F.sum("churned"), F.sum("k")).alias("churn_rate_pct"),
    )


def churn_distribution(features: DataFrame) -> DataFrame:
    return distribution(features, "churned").orderBy("churned")


def feature_summary(features: DataFrame) -> DataFrame:
    def mean(column: str) -> Column:
        return round_to(F.avg(column), 2)

    actions = "total_actions_so_far"
    return features.agg(
        mean(actions).alias("avg_total_actions"),
        F.min(actions).alias("min_total_actions"),
        F.max(actions).alias("max_total_actions"),
        mean("unique_event_types").alias("avg_unique_event_types"),
        mean("product_views").alias("avg_product_views"),
        mean("add_to_cart_actions").alias("avg_add_to_cart_actions"),
        mean("cart_views").alias("avg_cart_views"),
        mean("checkout_starts").alias("avg_checkout_starts"),
        mean("payment_attempts").alias("avg_payment_attempts"),
        mean("payment_errors").alias("avg_payment_errors"),
        mean("observed_session_duration_minutes").alias("avg_observed_duration_minutes"),
    )


def feature_categories(features: DataFrame) -> DataFrame:
    return distribution(features, *S.CATEGORICAL_FEATURES, percentage=False).orderBy(
        F.desc("sessions"), *S.CATEGORICAL_FEATURES
    )


def feature_correlations(
    features: DataFrame, columns: tuple[str, ...] = S.NUMERIC_FEATURES
) -> DataFrame:
    """Pearson matrix in long form: feature_a, feature_b, correlation.

    One pass, one centred sum of products a pair, so large values do not cancel;
    a row counts for a pair if it has both values. A constant feature has no
    correlation: NULL.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    rows = features.select(*[F.col(c).cast("double").alias(c) for c in columns])

    def corr(a: str, b: str) -> Column:
        # regr_* take the rows that have both; corr itself fails on a constant
        spread = F.sqrt(F.regr_sxx(a, b)) * F.sqrt(F.regr_syy(a, b))
        return F.try_divide(F.regr_sxy(a, b), spread)

    found = rows.agg(*[corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    triples = []
    for a, b in pairs:
        r = F.nanvl(F.col(f"{a}|{b}"), F.lit(None).cast("double")).alias("correlation")
        for left, right in dict.fromkeys([(a, b), (b, a)]):
            triples.append(
                F.struct(F.lit(left).alias("feature_a"), F.lit(right).alias("feature_b"), r)
            )
    return found.select(F.inline(F.array(*triples)))


def high_correlations(
    features: DataFrame,
    columns: tuple[str, ...] = S.NUMERIC_FEATURES,
    cut: float = S.CORRELATION_CUT,
) -> DataFrame:
    """Pairs of different features with |r| at or above the cut, strongest first."""
    place = {name: i for i, name in enumerate(columns)}
    order = F.create_map(*[F.lit(v) for item in place.items() for v in item])
    strength = F.abs("correlation")
    return (
        feature_correlations(features, columns)
        .where(order[F.col("feature_a")] < order[F.col("feature_b")])
        .where(strength >= cut)
        .withColumn("absolute_correlation", strength)
        .orderBy(F.desc("absolute_correlation"), "feature_a", "feature_b")
    )
