"""Ordered and keyed work that survives a hot key.

A window partitioned by session puts a whole session into one task; one bot
session may hold a third of all events. A key that holds more than one
thousandth of the rows is therefore cut into time segments: row-level work
runs per (key, segment), and what must cross a segment border travels through
a summary with one row per hot key and segment. All other keys are a single
segment and need one shuffle and no summary. Rows without a key are a group
like any other and can be hot as well (None in the list).

Rows that are already laid out by segment (see ``sources.sessions``) carry the
segment as a column; it is used as it is, so their windows need no shuffle.

Which keys count as hot only decides how work is spread. Results are the same
for any list of hot keys: rows and segment ends use one ordering, with NULL
times and NULL ties last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.columns import time_bucket

SEGMENT_SECONDS = 60
SEGMENT = "_segment"
HOT_SHARE = 1_000
TASK_ROWS = 5_000_000  # a key with more rows is hot whatever its share
MOST_HOT = 100_000  # bound of the list of hot keys
_WHOLE_KEY = -(2**62)  # the only segment of a key that is not hot
_NO_TIME = 2**62  # rows without a timestamp sort last, in a segment of their own


class _EveryKey(Sequence):
    """A list of hot keys that holds every key; not to be iterated."""

    def __len__(self) -> int:
        return 1

    def __getitem__(self, i):
        raise TypeError("every key is hot: there is no list of them")


EVERY_KEY = _EveryKey()


def hot_keys(
    df: DataFrame, key: str, share: int = HOT_SHARE, task_rows: int = TASK_ROWS
) -> list:
    """Keys with more than 1/``share`` of the rows or more than ``task_rows``.

    One pass over the key column with a frequent-items sketch (partial
    aggregation, nothing shuffled by key) that keeps as many keys as can have
    so many rows, at most ``MOST_HOT``.
    """
    n = df.count()
    share = min(MOST_HOT, max(share, n // task_rows))
    top = df.agg(F.expr(f"approx_top_k({key}, {share}, {10 * share})").alias("top")).first()["top"]
    return [entry["item"] for entry in top or [] if entry["count"] * share > n]


def is_hot(key: str, hot: Sequence) -> Column:
    if hot is EVERY_KEY:
        return F.lit(True)
    if not hot:
        return F.lit(False)
    known = F.coalesce(F.col(key).isin([k for k in hot if k is not None]), F.lit(False))
    return known | F.col(key).isNull() if None in hot else known


def segment_number(ts: str, seconds: int) -> Column:
    return F.coalesce(time_bucket(F.col(ts), seconds), F.lit(_NO_TIME)).cast("long")


def segment_of(key: str, ts: str, hot: Sequence, seconds: int) -> Column:
    whole = F.lit(_WHOLE_KEY).cast("long")
    if not hot:
        return whole
    if hot is EVERY_KEY:
        return segment_number(ts, seconds)
    return F.when(is_hot(key, hot), segment_number(ts, seconds)).otherwise(whole)


def cut_by_segment(df: DataFrame, key: str, ts: str, hot: Sequence, seconds: int) -> DataFrame:
    """Rows with their segment; as laid out, where they are."""
    if SEGMENT in df.columns:
        return df
    return df.withColumn(SEGMENT, segment_of(key, ts, hot, seconds))


def kept_segment(df: DataFrame) -> list[str]:
    """The column to keep for rows that are laid out by segment."""
    return [SEGMENT] if SEGMENT in df.columns else []


def _chain(key: str):
    return Window.partitionBy(key).orderBy(SEGMENT)


def _position(ts: str, tie: str) -> Column:
    """Place of a row among those of its key; NULL times and ties come last."""
    return F.struct(
        F.col(ts).isNull().alias("no_time"),
        F.col(ts).alias("time"),
        F.col(tie).isNull().alias("no_tie"),
        F.col(tie).alias("tie"),
    )


def _in_segment(key: str, ts: str, tie: str):
    # The order of _position; plain columns, so that windows share one sort.
    return Window.partitionBy(key, SEGMENT).orderBy(
        F.col(ts).asc_nulls_last(), F.col(tie).asc_nulls_last()
    )


def join_segments(rows: DataFrame, summary: DataFrame, key: str) -> DataFrame:
    """Left join by key and segment; rows without a key meet as well."""
    other = summary.withColumnsRenamed({key: "_summary_key", SEGMENT: "_summary_segment"})
    same = F.col(key).eqNullSafe(F.col("_summary_key")) & (
        F.col(SEGMENT) == F.col("_summary_segment")
    )
    return rows.join(other, same, "left")


def with_neighbours(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    carry: Sequence[str],
    hot: Sequence | None = None,
    seconds: int = SEGMENT_SECONDS,
) -> DataFrame:
    """Add structs ``previous`` and ``following`` holding ``carry`` of the
    neighbouring rows of the same key, ordered by (ts, tie).

    Rows are shuffled and sorted once, by (key, segment). The first and last
    row of a hot key's segment get their neighbour from the summary, which
    joins back on the same hash keys.
    """
    hot = hot_keys(df, key) if hot is None else hot
    here = F.struct(*carry)
    cut = cut_by_segment(df, key, ts, hot, seconds)
    local = _in_segment(key, ts, tie)
    rows = cut.withColumn("_here", here).select(
        *cut.columns,
        F.lag("_here").over(local).alias("previous"),
        F.lead("_here").over(local).alias("following"),
    )
    if not hot:
        return rows.drop(SEGMENT)
    position = _position(ts, tie)
    links = (
        cut.where(is_hot(key, hot))
        .groupBy(key, SEGMENT)
        .agg(
            F.min_by(here, position).alias("_first"),
            F.max_by(here, position).alias("_last"),
        )
        .select(
            key,
            SEGMENT,
            F.lag("_last").over(_chain(key)).alias("_before"),
            F.lead("_first").over(_chain(key)).alias("_after"),
        )
    )
    return join_segments(rows, links, key).select(
        *df.columns,
        F.coalesce("previous", "_before").alias("previous"),
        F.coalesce("following", "_after").alias("following"),
    )


def with_positions(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    position: str,
    total: str,
    hot: Sequence | None = None,
    seconds: int = SEGMENT_SECONDS,
) -> DataFrame:
    """Add the 1-based position of the row in its key and the key's row count."""
    hot = hot_keys(df, key) if hot is None else hot
    cut = cut_by_segment(df, key, ts, hot, seconds)
    local_count = F.count("*").over(Window.partitionBy(key, SEGMENT))
    rows = cut.select(
        *cut.columns,
        F.row_number().over(_in_segment(key, ts, tie)).cast("long").alias(position),
        local_count.alias(total),
    )
    if not hot:
        return rows.drop(SEGMENT)
    sums = cut.where(is_hot(key, hot)).groupBy(key, SEGMENT).agg(F.count("*").alias("_n"))
    earlier = _chain(key).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        key,
        SEGMENT,
        F.sum("_n").over(earlier).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(key)).alias("_total"),
    )
    return join_segments(rows, offsets, key).select(
        *df.columns,
        (F.col(position) + F.coalesce("_offset", F.lit(0))).alias(position),
        F.coalesce("_total", total).alias(total),
    )
