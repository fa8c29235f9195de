"""Data-quality gate and dataset checks on contract events."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.functions.columns import any_null, is_event, side_by_side, tally
from clickloom.functions.segments import with_neighbours


def row_defects() -> dict[str, Column]:
    """The gate's rules that look at one row at a time, by the name of their counter."""
    return {
        "missing_required_values": any_null(*S.REQUIRED_EVENT_COLUMNS),
        "invalid_event_names": ~F.col("event_name").isin(*S.EVENT_NAMES),
        "invalid_variants": ~F.col("variant").isin(*S.VARIANTS),
        "invalid_timestamps": F.col("event_timestamp").isNull(),
    }


def _over_ids(per_id: DataFrame, defects: Iterable[str]) -> DataFrame:
    """The report of rows by event_id: how many (``rows``) and their counters."""
    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("long")

    counters = per_id.agg(
        total("rows").alias("total_rows"),
        tally(F.col("rows") > 1).alias("duplicate_event_ids"),
        *[total(name).alias(name) for name in defects],
    )
    found = sum((F.col(c) for c in counters.columns if c != "total_rows"), start=F.lit(0))
    return counters.withColumn("is_valid", found == 0)


def quality_report(events: DataFrame) -> DataFrame:
    """One row: six counters and ``is_valid``.

    One scan and one shuffle: the counters are summed per event_id (partial
    aggregation folds a repeated id before the shuffle), then once over all.
    """
    defects = row_defects()
    counted = [tally(rule).alias(name) for name, rule in defects.items()]
    return _over_ids(events.groupBy("event_id").agg(F.count("*").alias("rows"), *counted), defects)


def row_counters() -> list[Column]:
    """What can be counted while the rows go by, for ``DataFrame.observe``."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        *[tally(rule).alias(name) for name, rule in row_defects().items()],
    ]


def report_of_counted(written: DataFrame, counted: Mapping[str, int]) -> DataFrame:
    """``quality_report`` of rows whose ``row_counters`` are known: it reads their ids only.

    Counts that do not fit the number of ids read (a part counted twice, or not
    at all) are not used; the rows are read instead.
    """
    ids = _over_ids(written.groupBy("event_id").agg(F.count("*").alias("rows")), []).drop("is_valid").first()
    if ids.total_rows != counted["total_rows"]:
        return quality_report(written)
    row = {**ids.asDict(), **{name: counted[name] for name in row_defects()}}
    valid = not any(count for name, count in row.items() if name != "total_rows")
    names = ", ".join(f"{name} long" for name in row)
    return written.sparkSession.createDataFrame([(*row.values(), valid)], f"{names}, is_valid boolean")


def dataset_overview(events: DataFrame) -> DataFrame:
    """Events, distinct users and sessions, first and last event.

    Rows are folded to (user, session) first; the two distinct counts then run
    over those pairs instead of over every event.
    """
    pairs = events.groupBy("user_id", "session_id").agg(
        F.count("*").alias("n"),
        F.min("event_timestamp").alias("first_ts"),
        F.max("event_timestamp").alias("last_ts"),
    )
    return pairs.agg(
        F.sum("n").alias("total_events"),
        F.count_distinct("user_id").alias("total_users"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.min("first_ts").alias("first_event"),
        F.max("last_ts").alias("last_event"),
    )


def event_distribution(events: DataFrame, by_name: bool = False) -> DataFrame:
    counts = events.groupBy("event_name").agg(F.count("*").alias("event_count"))
    if by_name:
        return counts.orderBy("event_name")
    return counts.orderBy(F.desc("event_count"), "event_name")


def session_order_check(events: DataFrame, hot: Sequence[str] | None = None) -> DataFrame:
    """Events earlier than their predecessor in session order.

    The order is by the compared timestamp itself, so the count is 0 unless
    the ordering is broken; kept as the contract defines it.
    """
    rows = with_neighbours(
        events.select("session_id", "event_timestamp", "event_id"),
        "session_id",
        "event_timestamp",
        "event_id",
        ["event_timestamp"],
        hot,
    )
    late = F.col("event_timestamp") < F.col("previous.event_timestamp")
    return rows.agg(tally(late).alias("out_of_order_events"))


def missing_ids(events: DataFrame) -> DataFrame:
    return events.agg(
        tally(F.col("user_id").isNull()).alias("missing_user_ids"),
        tally(F.col("session_id").isNull()).alias("missing_session_ids"),
    )


def load_reconciliation(landing: DataFrame, loaded: DataFrame) -> DataFrame:
    return side_by_side(
        landing.agg(F.count("*").alias("landing_rows")),
        loaded.agg(F.count("*").alias("warehouse_rows")),
    ).withColumn("row_difference", F.col("landing_rows") - F.col("warehouse_rows"))


def session_boundary(events: DataFrame) -> DataFrame:
    """Sessions without exactly one start, and without exactly one end."""
    per_session = events.groupBy("session_id").agg(
        tally(is_event("session_start")).alias("starts"),
        tally(is_event("session_end")).alias("ends"),
    )
    return per_session.agg(
        tally(F.col("starts") != 1).alias("invalid_session_starts"),
        tally(F.col("ends") != 1).alias("invalid_session_ends"),
    )


def _assignments(events: DataFrame) -> DataFrame:
    """Distinct (user, experiment, variant): a hot user folds before the shuffle."""
    return events.select("user_id", "experiment_id", "variant").distinct()


def unstable_assignment(events: DataFrame) -> DataFrame:
    """Users without exactly one experiment and exactly one variant."""
    return (
        _assignments(events)
        .groupBy("user_id")
        .agg(
            F.count_distinct("experiment_id").alias("experiment_count"),
            F.count_distinct("variant").alias("variant_count"),
        )
        .where((F.col("experiment_count") != 1) | (F.col("variant_count") != 1))
    )


def inconsistent_users(events: DataFrame) -> DataFrame:
    """How many users saw more than one variant of an experiment."""
    return (
        events.where(F.col("experiment_id").isNotNull())
        .select("user_id", "variant")
        .distinct()
        .groupBy("user_id")
        .agg(F.count("variant").alias("variants"))
        .agg(tally(F.col("variants") > 1).alias("inconsistent_users"))
    )


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count of every column of the table, in one pass."""
    return df.agg(*[tally(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
