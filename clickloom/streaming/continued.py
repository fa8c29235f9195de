"""Session funnel of a stream whose sessions may go on after they were closed.

A session is published when it has been quiet for ``gap`` and the watermark has
passed that point. Its state is kept for ``keep`` longer. Events that come in that
time (a session that goes on, or events that are late by less than the watermark's
``lateness``) give a correction at once: the whole row again under the next version.
The last version of a session is what the batch funnel gives over all its events.

State is one row a session (its first event of each funnel step), whatever its
number of events, and one event time that is due: first for the close, then for the
end of ``keep``, after which the row is removed. The rows are a table beside the
checkpoint: a micro-batch folds its events to one row a session, joins them with the
state of the batch before and writes the next one, all by Spark's own expressions, so
no session costs a call of Python. Open sessions are read and written once a batch;
of older states one is kept, which a batch that is run again starts from.

Corrections are appended, never updated: each batch writes the versions it gives to
a folder of its own number (column ``batch``) and replaces it when it is run again.

Defined results: events not later than the watermark of the batches before are
dropped; events without a session or a time are left out (the gate refuses them);
sessions without a funnel event give no row; an event seen twice changes nothing; a
session that comes back after ``keep`` starts anew from the events that come then,
and ``latest_funnel`` takes those. Of events with one time the smallest event_id is
first, then the smallest user_id, NULL before any, as in the batch funnel.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickloom import schema as S
from clickloom.functions.columns import seconds_between
from clickloom.operators.funnel import owners_of_steps

_STEPS = range(len(S.FUNNEL_STEPS))
_FIRST = T.StructType(
    [T.StructField("at", T.LongType()), T.StructField("event", T.StringType()), T.StructField("user", T.StringType())]
)
# The first event of each step, side by side: time in microseconds, id, user.
_FIRSTS = [T.StructField(f"{f.name}_{i}", f.dataType) for i in _STEPS for f in _FIRST]
_STATE = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("last_at", T.LongType()),
        *[T.StructField(f"first_{i}", _FIRST) for i in _STEPS],
        T.StructField("closed", T.BooleanType()),
        T.StructField("due", T.LongType()),
        T.StructField("given", T.BooleanType()),  # a version of this batch
        T.StructField("over", T.BooleanType()),  # not kept for the next one
    ]
)


def _milliseconds(span: str, stream: DataFrame) -> int:
    """Length of an interval such as ``30 minutes``."""
    seconds = seconds_between(F.lit(0).cast("timestamp"), F.lit(0).cast("timestamp") + F.expr(f"interval {span}"))
    return int(stream.sparkSession.range(1).select(seconds * 1000).first()[0])


def _millis(micros: Column) -> Column:
    return F.floor(micros / 1000)


def folded(events: DataFrame, watermark: int | None) -> DataFrame:
    """One row a session of the events that are not late: its last time and first events."""
    in_time = events if watermark is None else events.where(F.col("at") > watermark * 1000)
    event = F.struct("at", F.col("event_id").alias("event"), F.col("user_id").alias("user"))
    return in_time.groupBy("session_id").agg(
        F.max("at").alias("last_at"), *[F.min(F.when(F.col("step") == i, event)).alias(f"first_{i}") for i in _STEPS]
    )


def next_state(
    state: DataFrame, news: DataFrame, before: int | None, watermark: int | None, gap_ms: int, keep_ms: int
) -> DataFrame:
    """What each session's row becomes by its new events, under the watermark ``before``
    them, and then by its due time, under the ``watermark`` after them."""
    old = state.withColumnsRenamed({f: f"old_{f}" for f in state.columns if f != "session_id"})
    both = old.join(news.withColumn("fresh", F.lit(True)), "session_id", "full")
    changed = reduce(
        lambda a, b: a | b,
        [F.col(f"first_{i}").isNotNull() & ~F.least(f"old_first_{i}", f"first_{i}").eqNullSafe(F.col(f"old_first_{i}")) for i in _STEPS],
    )
    closed, version = F.coalesce("old_closed", F.lit(False)), F.coalesce("old_version", F.lit(0))
    # closed without a funnel event: open again with its first one
    again = closed & changed & (version == 0)
    corrected = closed & changed & (version > 0)
    taken = both.select(
        "session_id",
        F.when(corrected, version + 1).otherwise(version).alias("version"),
        F.greatest("old_last_at", "last_at").alias("last_at"),
        *[F.least(f"old_first_{i}", f"first_{i}").alias(f"first_{i}") for i in _STEPS],
        (closed & ~again).alias("closed"),
        corrected.alias("corrected"),
        F.when(~F.coalesce("fresh", F.lit(False)), F.col("old_due")).alias("due"),
    )

    def due(closed: Column, now: int | None) -> Column:
        at = _millis(F.col("last_at")) + gap_ms + F.when(closed, keep_ms).otherwise(0)
        return at if now is None else F.greatest(at, F.lit(now + 1))

    timed = taken.withColumn("due", F.coalesce("due", due(F.col("closed"), before)))
    fires = F.lit(False) if watermark is None else F.col("due") < watermark
    closes = fires & ~F.col("closed")
    published = closes & reduce(lambda a, b: a | b, [F.col(f"first_{i}").isNotNull() for i in _STEPS])
    return timed.select(
        "session_id",
        F.when(published, F.col("version") + 1).otherwise(F.col("version")).cast("int").alias("version"),
        "last_at",
        *[f"first_{i}" for i in _STEPS],
        (F.col("closed") | closes).alias("closed"),
        F.when(closes, due(F.lit(True), watermark)).otherwise(F.col("due")).cast("long").alias("due"),
        (F.col("corrected") | published).alias("given"),
        (fires & F.col("closed")).alias("over"),
    )


@dataclass(frozen=True)
class FunnelVersions:
    """Versions (session_id, version, last_at, first event of each step) of a stream of
    events (session_id, user_id, event_id, time and step); ``append_events`` starts it."""

    events: DataFrame
    gap_ms: int
    lateness_ms: int
    keep_ms: int

    def append_to(self, path: str, checkpoint: str) -> StreamingQuery:
        """Append the versions to a Parquet table, a folder a micro-batch."""
        root = f"{checkpoint.rstrip('/')}/sessions"

        def take(batch: DataFrame, number: int) -> None:
            spark = batch.sparkSession
            former, here = f"{root}/{(number - 1) % 2}", f"{root}/{number % 2}"
            state, before = spark.createDataFrame([], _STATE), None
            if number:
                state = spark.read.schema(_STATE).parquet(f"{former}/state").where("NOT over")
                before = spark.read.parquet(f"{former}/watermark").first().watermark
            folded(batch, before).write.mode("overwrite").parquet(f"{here}/news")
            news = spark.read.parquet(f"{here}/news")
            newest = news.agg(_millis(F.max("last_at"))).first()[0]
            reached = [w for w in (before, None if newest is None else newest - self.lateness_ms) if w is not None]
            watermark = max(reached, default=None)
            after = next_state(state.drop("given", "over"), news, before, watermark, self.gap_ms, self.keep_ms)
            after.write.mode("overwrite").parquet(f"{here}/state")
            given = spark.read.schema(_STATE).parquet(f"{here}/state").where("given")
            firsts = [F.col(f"first_{i}.{f.name}").alias(f"{f.name}_{i}") for i in _STEPS for f in _FIRST]
            given.select("session_id", "version", "last_at", *firsts).write.mode("overwrite").parquet(f"{path}/batch={number}")
            spark.range(1).select(F.lit(watermark).cast("long").alias("watermark")).write.mode("overwrite").parquet(
                f"{here}/watermark"
            )

        return (
            self.events.writeStream.foreachBatch(take)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def funnel_versions(
    stream: DataFrame, gap: str = "30 minutes", lateness: str = "1 hour", keep: str = "1 day"
) -> FunnelVersions:
    """Versions of the stream's sessions, to be appended to a table."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    at = (seconds_between(epoch, F.col("event_timestamp")) * 1_000_000).cast("long")
    step = F.coalesce(F.array_position(F.array(*map(F.lit, S.FUNNEL_STEPS)), F.col("event_name")), F.lit(0)) - 1
    events = stream.where(F.col("session_id").isNotNull() & F.col("event_timestamp").isNotNull()).select(
        "session_id", "user_id", "event_id", at.alias("at"), step.cast("int").alias("step")
    )
    return FunnelVersions(events, *[_milliseconds(span, stream) for span in (gap, lateness, keep)])


def _time(micros: Column) -> Column:
    """Zone-free time of microseconds since 1970."""
    seconds = (micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def latest_funnel(versions: DataFrame) -> DataFrame:
    """Session funnel by the last version of each session; one shuffle, folded before it."""
    firsts = F.struct(*[field.name for field in _FIRSTS])
    last = versions.groupBy("session_id").agg(F.max_by(firsts, F.struct("last_at", "version")).alias("last"))
    steps = [
        F.when(
            F.col(f"last.at_{i}").isNotNull(),
            F.struct(
                _time(F.col(f"last.at_{i}")).alias("event_timestamp"),
                F.col(f"last.event_{i}").alias("event_id"),
                F.col(f"last.user_{i}").alias("user_id"),
            ),
        ).alias(step)
        for i, step in enumerate(S.FUNNEL_STEPS)
    ]
    return owners_of_steps(last.select("session_id", *steps))
