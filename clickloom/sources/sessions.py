"""Events laid out by session: shuffled once when written, not by every reader.

Operators that work on sessions shuffle the events by session_id. A session
layout does it once: ordinary sessions are written in buckets of session_id, one
sorted file a bucket, and Spark takes the partitioning of a scan from the table,
so their windows and aggregates need no exchange of event rows.

Hot sessions would make their bucket as long as the session. They are kept
apart, in buckets of (session_id, segment of time), the unit in which the
operators work on them. Rows without a session are a session like any other.

``per_session`` runs an operator over both parts. A session is in one part
only, so for any operator whose rows belong to one session that is the operator
over all events.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.segments import (
    EVERY_KEY,
    SEGMENT,
    SEGMENT_SECONDS,
    hot_keys,
    is_hot,
    segment_number,
)

BUCKET_ROWS = 1_000_000  # rows a bucket is laid out for
MOST_BUCKETS = 100_000
MANY_KEYS = 1_000  # longer lists of hot keys are joined instead of written into the plan

# Called with events, the hot keys among them and the segments' width.
SessionOperator = Callable[[DataFrame, Sequence, int], DataFrame]


@dataclass(frozen=True)
class SessionLayout:
    """What a reader has to know of a layout: two folders and how they are cut."""

    path: str
    schema: str  # of the events, as DDL
    buckets: int
    hot_buckets: int  # 0: no session is hot
    seconds: int

    def as_dict(self) -> dict:
        return dict(self.__dict__)

    # ---------------------------------------------------------------- reading
    def _bucketed(self, spark: SparkSession, part: str, keys: Sequence[str], buckets: int) -> DataFrame:
        """A scan of one part that Spark knows to be bucketed.

        Buckets are known to tables of the catalog only, so the folder gets a
        name there; dropping the name leaves the files.
        """
        name = f"sessions_{uuid.uuid5(uuid.NAMESPACE_URL, f'{self.path}/{part}').hex}"
        if not spark.catalog.tableExists(name):
            columns = self.schema + (f", {SEGMENT} BIGINT" if part == "hot" else "")
            spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet "
                f"CLUSTERED BY ({', '.join(keys)}) INTO {buckets} BUCKETS LOCATION '{self.path}/{part}'"
            )
        return spark.table(name)

    def ordinary(self, spark: SparkSession) -> DataFrame:
        """Events of the sessions that fit into one task, partitioned by session_id."""
        return self._bucketed(spark, "ordinary", ["session_id"], self.buckets)

    def hot(self, spark: SparkSession) -> DataFrame | None:
        """Events of hot sessions with their segment, partitioned by both; None if there are none."""
        if not self.hot_buckets:
            return None
        return self._bucketed(spark, "hot", ["session_id", SEGMENT], self.hot_buckets)

    def events(self, spark: SparkSession) -> DataFrame:
        """All events, in no particular partitioning."""
        hot = self.hot(spark)
        return self.ordinary(spark) if hot is None else self.ordinary(spark).unionByName(hot.drop(SEGMENT))

    def per_session(self, spark: SparkSession, operator: SessionOperator) -> DataFrame:
        """``operator(events, hot keys, seconds)`` over all sessions."""
        result, hot = operator(self.ordinary(spark), [], self.seconds), self.hot(spark)
        return result if hot is None else result.unionByName(operator(hot, EVERY_KEY, self.seconds))


def _buckets(rows: int, bucket_rows: int) -> int:
    """A power of two: layouts of different sizes can still be joined bucket by bucket."""
    n = 1
    while n * bucket_rows < rows and n < MOST_BUCKETS:
        n *= 2
    return n


def _marked(events: DataFrame, hot: Sequence, path: str) -> DataFrame:
    """Events with the flag ``_hot``."""
    if len(hot) <= MANY_KEYS:
        return events.withColumn("_hot", is_hot("session_id", hot))
    # At most 100,000 keys (hot_keys bounds them), so the broadcast is bounded.
    spark, ddl = events.sparkSession, "hot_key string, _hot boolean"
    spark.createDataFrame([(k, True) for k in hot], ddl).write.parquet(f"{path}/hot_keys")
    keys = F.broadcast(spark.read.schema(ddl).parquet(f"{path}/hot_keys"))
    joined = events.join(keys, F.col("session_id").eqNullSafe(F.col("hot_key")), "left")
    return joined.drop("hot_key").withColumn("_hot", F.coalesce("_hot", F.lit(False)))


def _write(rows: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """One file a bucket: rows are dealt by the hash that buckets are numbered by."""
    name = f"writing_{uuid.uuid4().hex}"
    try:
        (
            rows.repartition(buckets, *keys)
            .write.bucketBy(buckets, *keys)
            .sortBy(*dict.fromkeys([*keys, "event_timestamp", "event_id"]))
            .option("compression", "zstd")
            .option("path", path)
            .saveAsTable(name)
        )
    finally:
        rows.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def write_layout(
    events: DataFrame,
    path: str,
    hot: Sequence | None = None,
    seconds: int = SEGMENT_SECONDS,
    bucket_rows: int = BUCKET_ROWS,
    buckets: int | None = None,
) -> SessionLayout:
    """Lay ``events`` out below ``path``, which must be new.

    ``hot`` lists session ids to keep apart; None finds them in one pass.
    ``buckets`` fixes the number of buckets, else ``bucket_rows`` decides.
    """
    spark = events.sparkSession
    hot = hot_keys(events, "session_id") if hot is None else list(hot)
    marked = _marked(events, hot, path) if hot else events.withColumn("_hot", F.lit(False))
    sizes = {r["_hot"]: r["n"] for r in marked.groupBy("_hot").agg(F.count("*").alias("n")).collect()}
    n = buckets or _buckets(sizes.get(False, 0), bucket_rows)
    _write(marked.where(~F.col("_hot")).drop("_hot"), f"{path}/ordinary", ["session_id"], n)
    n_hot = _buckets(sizes.get(True, 0), bucket_rows) if sizes.get(True) else 0
    if n_hot:
        n_hot = max(n_hot, n)
        split = marked.where("_hot").drop("_hot").withColumn(SEGMENT, segment_number("event_timestamp", seconds))
        _write(split, f"{path}/hot", ["session_id", SEGMENT], n_hot)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema.fields)
    return SessionLayout(path, schema, n, n_hot, seconds)
