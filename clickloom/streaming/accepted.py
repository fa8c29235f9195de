"""Index of the ids that earlier micro-batches have had accepted.

Beside each accepted batch stand its span (least and greatest id, number of
rows) and a blocked Bloom filter of its ids. A new batch is held against the
spans, then against the filters of the batches whose span it meets; only batches
that may hold one of its ids are read, and a join on the ids themselves decides.

A filter is a table of 256-bit blocks, four longs each. An id chooses one block
and sets two bits in each long, so one lookup a batch tells whether it may be
there. With ``BITS_PER_ID`` 32 about one id in 100,000 is asked for in vain,
which costs a read and never changes a result. Filters are built by one aggregate and
asked by one join; neither ids nor filters go to the driver, only the numbers of
batches and their spans.

A batch is indexed after its rows are written. A failure in between leaves it
without index until it is retried under its own number; batches without index,
also those of a history older than the index, are read always. Null ids are in
no filter; an empty batch has an index that matches nothing.
"""

from __future__ import annotations

import math
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS_PER_ID = 32
BLOCK_BITS = 256
LONGS = 4
MAX_DIGITS = 24  # of a block's number; larger batches fill their filter more and are read more often
_SPAN = "batch long, least string, greatest string, ids long, digits int"
_BLOCKS = "batch long, digits int, block long, " + ", ".join(f"w{i} long" for i in range(LONGS))


def _digits(ids: int) -> int:
    """Binary digits of a block's number in a filter for so many ids."""
    return min(MAX_DIGITS, max(1, math.ceil(math.log2(max(1, ids) * BITS_PER_ID / BLOCK_BITS))))


def _block(digits: Column) -> Column:
    """Number of the block of an id: the first digits of its hash."""
    return F.call_function("shiftrightunsigned", F.xxhash64("event_id"), (F.lit(64) - digits).cast("int"))


def _masks() -> list[Column]:
    """The bits of an id in each long of its block."""
    hashed = F.xxhash64("event_id", F.lit("bits"))
    one = F.lit(1).cast("long")

    def bit(i: int) -> Column:
        place = F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", one, place)

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(LONGS)]


def record(rows: DataFrame, index: str, number: int) -> None:
    """Write the span and the filter of accepted batch ``number``, replacing those of an earlier try."""
    known = rows.where("event_id IS NOT NULL")
    span = known.agg(
        F.min("event_id").alias("least"), F.max("event_id").alias("greatest"), F.count(F.lit(1)).alias("ids")
    ).first()
    digits = _digits(span.ids)
    blocks = (
        known.select(_block(F.lit(digits)).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks())])
        .groupBy("block")
        .agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(LONGS)])
        .select(F.lit(digits).alias("digits"), "block", *[f"w{i}" for i in range(LONGS)])
    )
    blocks.write.mode("overwrite").parquet(f"{index}/blocks/batch={number}")
    # The span comes last: a batch counts as indexed once it has one.
    spans = rows.sparkSession.createDataFrame([(number, span.least, span.greatest, span.ids, digits)], _SPAN)
    spans.drop("batch").write.mode("overwrite").parquet(f"{index}/spans/batch={number}")


def _stored(spark: SparkSession, path: str, fields: str) -> DataFrame:
    try:
        return spark.read.schema(fields).parquet(path)
    except AnalysisException:  # nothing there yet
        return spark.createDataFrame([], fields)


def batches_of(spark: SparkSession, accepted: str) -> set[int]:
    """Numbers of the accepted batches, from the listing of their files."""
    try:
        files = spark.read.schema("event_id string, batch long").parquet(accepted).inputFiles()
    except AnalysisException:  # nothing accepted yet
        return set()
    return {int(n) for f in files for n in re.findall(r"/batch=(\d+)/", f)}


def batches_to_read(ids: DataFrame, accepted: str, index: str, number: int) -> list[int]:
    """Accepted batches other than ``number`` that may hold one of ``ids`` (event_id)."""
    spark = ids.sparkSession
    there = batches_of(spark, accepted) - {number}
    if not there:
        return []
    span = ids.agg(F.min("event_id").alias("least"), F.max("event_id").alias("greatest")).first()
    if span.least is None:
        return []
    spans = _stored(spark, f"{index}/spans", _SPAN).select(
        "batch", "digits", ((F.col("least") <= span.greatest) & (F.col("greatest") >= span.least)).alias("meets")
    )
    indexed = {row.batch: row for row in spans.collect() if row.batch in there}
    met = [n for n, row in indexed.items() if row.meets]
    found: set[int] = set()
    if met:
        sizes = F.array(*[F.lit(d) for d in sorted({indexed[n].digits for n in met})])
        asked = ids.where("event_id IS NOT NULL").select(
            F.explode(sizes).alias("digits"), "event_id", *[m.alias(f"m{i}") for i, m in enumerate(_masks())]
        )
        asked = asked.select("digits", _block(F.col("digits")).alias("block"), *[f"m{i}" for i in range(LONGS)])
        blocks = _stored(spark, f"{index}/blocks", _BLOCKS).where(F.col("batch").isin(met))
        hit = F.lit(True)
        for i in range(LONGS):
            hit &= F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}")
        hits = blocks.join(asked, ["digits", "block"]).where(hit).select("batch").distinct()
        found = {row.batch for row in hits.collect()}
    return sorted(found | (there - set(indexed)))


def accepted_before(ids: DataFrame, accepted: str, index: str, number: int) -> DataFrame:
    """Those of ``ids`` that a batch other than ``number`` has had accepted, each once."""
    spark = ids.sparkSession
    paths = [f"{accepted}/batch={n}" for n in batches_to_read(ids, accepted, index, number)]
    if not paths:
        return spark.createDataFrame([], "event_id string")
    earlier = spark.read.schema("event_id string").parquet(*paths)
    return earlier.join(ids, "event_id", "left_semi").distinct()
