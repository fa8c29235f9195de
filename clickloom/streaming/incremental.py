"""Incremental loads of the landing with Structured Streaming.

All runs use the ``availableNow`` trigger: each call takes what has landed
since its checkpoint and stops.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom import schema as S
from clickloom.functions.columns import any_null, is_event, seconds_between
from clickloom.operators.funnel import with_reached_flags
from clickloom.operators.quality import quality_report
from clickloom.sources.landing import conform
from clickloom.streaming.accepted import accepted_before, record
from clickloom.streaming.continued import FunnelVersions


def landing_stream(spark: SparkSession, landing_glob: str) -> DataFrame:
    """New event files of the landing as a stream under the event contract.

    A column that a file lacks is NULL there; columns beyond the contract are
    not read.
    """
    return conform(spark.readStream.schema(S.EVENT_SCHEMA).parquet(landing_glob))


_CLOCK = "_event_time"


def _clocked(stream: DataFrame, lateness: str) -> DataFrame:
    """Watermark on the event time read as UTC: Spark takes zoned timestamps
    only, and a cast would move with the session time zone."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    micros = seconds_between(epoch, F.col("event_timestamp")) * 1_000_000
    return stream.withColumn(_CLOCK, F.timestamp_micros(micros.cast("long"))).withWatermark(
        _CLOCK, lateness
    )


def deduplicated(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """One row per event_id among events at most ``lateness`` apart.

    State holds ids within the watermark only, so it does not grow with the
    stream.
    """
    return _clocked(stream, lateness).dropDuplicatesWithinWatermark(["event_id"]).drop(_CLOCK)


def append_events(stream: DataFrame | FunnelVersions, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet table; exactly once by the file sink's log, or by
    folders of the batches' numbers where the stream keeps a state of its own."""
    if isinstance(stream, FunnelVersions):
        return stream.append_to(path, checkpoint)
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )


def row_is_valid() -> Column:
    """The gate's rules for a single row."""
    rules = [
        ~any_null(*S.REQUIRED_EVENT_COLUMNS),
        F.col("event_name").isin(*S.EVENT_NAMES),
        F.col("variant").isin(*S.VARIANTS),
    ]
    return F.coalesce(reduce(lambda a, b: a & b, rules), F.lit(False))


def gated_load(
    stream: DataFrame, accepted: str, quarantine: str, reports: str, checkpoint: str, index: str | None = None
) -> StreamingQuery:
    """Quality gate per micro-batch.

    Rows that keep the rules are accepted. Rows that break one, all rows of an
    id that occurs more than once in the batch, and rows of an id that an
    earlier batch has had accepted go to quarantine. The batch's report is
    stored beside them. Each batch writes to folders of its own number and
    replaces them when it is retried; it is read once.

    Ids of earlier batches are looked up through ``index`` (by default beside
    ``accepted``), so that only batches that may hold one of this batch's are read.
    """
    index = index or f"{accepted.rstrip('/')}-index"

    def take(batch: DataFrame, number: int) -> None:
        def store(df: DataFrame, root: str) -> None:
            df.write.mode("overwrite").parquet(f"{root}/batch={number}")

        batch.persist()
        repeated = (
            batch.groupBy("event_id").count().where("count > 1").select("event_id")
        )
        repeated = repeated.union(accepted_before(batch.select("event_id"), accepted, index, number))
        marked = batch.withColumn("is_valid", row_is_valid())
        good = marked.where("is_valid").drop("is_valid").join(repeated, "event_id", "left_anti")
        twice = marked.where("is_valid").drop("is_valid").join(repeated, "event_id", "left_semi")
        bad = marked.where(~F.col("is_valid")).drop("is_valid")
        store(quality_report(batch), reports)
        store(good, accepted)
        store(bad.unionByName(twice), quarantine)
        record(batch.sparkSession.read.parquet(f"{accepted}/batch={number}"), index, number)
        batch.unpersist()

    return (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def rolling_funnel(
    stream: DataFrame, gap: str = "30 minutes", lateness: str = "1 hour"
) -> DataFrame:
    """Session funnel of sessions that ended: quiet for ``gap`` and past the
    watermark. Append mode; one row a session, when it is closed.

    Every event of a session keeps it open, not only those of the funnel, and
    whoever sent them; the row names the user of the session's first funnel
    event. Sessions without a funnel event give no row. A session that is quiet
    for longer than ``gap`` and then goes on is two sessions here.
    """
    at = F.col("event_timestamp")
    in_funnel = F.col("event_name").isin(*S.FUNNEL_STEPS)
    first = F.min(F.when(in_funnel, F.struct(at, F.col("event_id"), F.col("user_id"))))
    return with_reached_flags(
        _clocked(stream, lateness)
        .groupBy(F.session_window(_CLOCK, gap), "session_id")
        .agg(
            first.alias("first"),
            *[
                F.min(F.when(is_event(step), at)).alias(f"{step}_at")
                for step in S.FUNNEL_STEPS
            ],
        )
        .where(F.col("first").isNotNull())
        .withColumn("user_id", F.col("first.user_id"))
        .drop("session_window", "first")
    )
