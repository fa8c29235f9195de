"""Small column expressions and one-row report helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def round_to(value: Column, digits: int) -> Column:
    """Nearest multiple of 10**-digits of the scaled double, halves away from 0.

    ``round(x, d)`` rounds the shortest decimal text of x, which differs from
    rounding ``x * 10**d`` where x is a hair below a half.
    """
    scale = float(10**digits)
    return F.round(value.cast("double") * scale) / scale


def share(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """``100 * part / whole`` as DOUBLE; NULL when ``whole`` is 0."""
    value = F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))
    return value if digits is None else round_to(value, digits)


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as DOUBLE, 0.0 when ``whole`` is 0 (zero_division=0)."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def seconds_between(start: Column, end: Column) -> Column:
    """Exact seconds from ``start`` to ``end`` (zone-free timestamps).

    Interval subtraction never touches the session time zone, and 18 digits
    stay in a long.
    """
    return (end - start).cast("decimal(18,6)")


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end).cast("double") / F.lit(60.0)


def time_bucket(ts: Column, seconds: int) -> Column:
    """Number of the ``seconds``-wide bucket since 1970 that holds ``ts``."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.floor(seconds_between(epoch, ts).cast("double") / F.lit(float(seconds)))


def tally(condition: Column) -> Column:
    """How many rows satisfy ``condition``; NULL conditions are not counted."""
    return F.count_if(condition)


def any_null(*names: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])


def is_event(name: str) -> Column:
    return F.col("event_name") == F.lit(name)


def flag(condition: Column) -> Column:
    """1 when true, else 0 (also for NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def ranked_by(column: str, order: tuple[str, ...]) -> Column:
    """Sort key: 1-based position of the value in ``order``, last for others."""
    key = F.lit(len(order) + 1)
    for position, value in reversed(list(enumerate(order, start=1))):
        key = F.when(F.col(column) == value, F.lit(position)).otherwise(key)
    return key


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with different columns next to each other.

    The rows are stacked with NULL in the foreign columns and folded by one
    aggregate, so no cross join is planned.
    """
    names = [name for frame in frames for name in frame.columns]
    if len(names) != len(set(names)):
        raise ValueError(f"report columns overlap: {names}")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(name).alias(name) for name in names])


def distribution(df: DataFrame, *by: str, percentage: bool = True) -> DataFrame:
    """Rows per value with the share of the total.

    The unpartitioned window runs over the grouped rows only: one row per
    value of a small vocabulary (bands, outcomes, labels).
    """
    counts = df.groupBy(*by).agg(F.count("*").alias("sessions"))
    if not percentage:
        return counts
    total = F.sum("sessions").over(Window.partitionBy())
    return counts.withColumn("percentage", share(F.col("sessions"), total))
