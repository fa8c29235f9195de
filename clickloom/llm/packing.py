"""Packing with optimal length buckets.

Texts longer than ``MAX_LENGTH`` words are cut into pieces of that length and a
rest, so lengths are at most ``MAX_LENGTH`` and the global histogram has at
most as many rows, whatever the input; it is the only thing that goes to the
driver. Dynamic programming over it chooses the ``BUCKETS`` upper bounds that
minimise padding: all pieces of a bucket are padded to its upper bound, the
longest length in it. The optimum is exact; divide and conquer over the split
points keeps it at lengths x log(lengths) steps a bucket.

Inside a bucket, batches hold as many pieces as fit the token budget. Pieces
are numbered without collecting a bucket: identical pieces are folded, spread
over shards by hash, numbered inside a shard and offset by the counts of the
shards before it.

Defined results: a text without words, or null, makes no piece; equal pieces
are interchangeable; an empty table makes no batches. A batch is full but for
the last one of its bucket.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import stored, word_count, words_of

MAX_LENGTH = 2_048
BUCKETS = 16
BUDGET = 16_384  # padded words of a batch
PER_SHARD = 50_000
PER_CHUNK = 1_000  # copies of one piece that are numbered together


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of the buckets with the least padding in all.

    ``lengths`` ascend. cost(i, j) pads lengths i..j-1 to the last of them; the
    best split point of a prefix never falls as the prefix grows.
    """
    n = len(lengths)
    if n == 0:
        return []
    pieces = np.concatenate(([0], np.cumsum(counts))).astype(float)
    words = np.concatenate(([0], np.cumsum(lengths * counts))).astype(float)
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    choices = []
    for _ in range(min(buckets, n)):
        now, chosen = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        todo = [(1, n, 0, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            cost = best[i] + lengths[j - 1] * (pieces[j] - pieces[i]) - (words[j] - words[i])
            k = int(cost.argmin())
            now[j], chosen[j] = cost[k], i[k]
            todo += [(low, j - 1, first, chosen[j]), (j + 1, high, chosen[j], last)]
        choices.append(chosen)
        best = now
        best[0] = 0.0  # fewer buckets are allowed
    bounds, j = [], n
    for chosen in reversed(choices):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(chosen[j])
    return bounds[::-1]


def pieces_of(docs: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """doc_id, piece (0, 1, ..) and length of every piece."""
    sized = docs.select("doc_id", word_count(F.col("text")).alias("n_words")).where("n_words > 0")
    last = F.floor((F.col("n_words") - 1) / max_length)
    return sized.withColumn("piece", F.explode(F.sequence(F.lit(0), last.cast("int")))).select(
        "doc_id",
        "piece",
        F.least(F.lit(max_length), F.col("n_words") - F.col("piece") * max_length).alias("length"),
    )


def pack(
    docs: DataFrame,
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """One row a piece: where it starts, its bucket, batch and place in it.

    Columns: doc_id, piece, start_word, length, bucket, padded_length,
    batch (numbered inside the bucket), slot, padding.
    """
    pieces = stored(pieces_of(docs, max_length).groupBy("doc_id", "piece", "length").count(), "pieces")
    histogram = pieces.groupBy("length").agg(F.sum("count").alias("n")).orderBy("length").collect()
    lengths = np.array([r["length"] for r in histogram], np.int64)
    counts = np.array([r["n"] for r in histogram], np.int64)
    bounds = best_bounds(lengths, counts, buckets)
    if not bounds:
        bounds = [max_length]
    upper = F.array(*map(F.lit, bounds))
    bucket = F.size(F.filter(upper, lambda b: b < F.col("length")))
    shards = max(1, -(-int(counts.sum()) // PER_SHARD))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("count") - 1) / PER_CHUNK)))
    chunks = (
        pieces.withColumn("bucket", bucket)
        .withColumn("chunk", chunk)
        .withColumn("n", F.least(F.lit(PER_CHUNK), F.col("count") - F.col("chunk") * PER_CHUNK))
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "chunk"), F.lit(shards)))
    )
    inside = Window.partitionBy("bucket", "shard").orderBy("doc_id", "piece", "length", "chunk")
    numbered = chunks.withColumn("before", F.sum("n").over(inside) - F.col("n"))
    # One row a bucket and shard: the buckets are few, so this window is small.
    sums = chunks.groupBy("bucket", "shard").agg(F.sum("n").alias("in_shard"))
    ahead = Window.partitionBy("bucket").orderBy("shard")
    offsets = sums.select(
        "bucket", "shard", (F.sum("in_shard").over(ahead) - F.col("in_shard")).alias("offset")
    )
    padded = F.element_at(upper, F.col("bucket") + 1)
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("padded_length")))
    return (
        numbered.join(offsets, ["bucket", "shard"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .withColumn("padded_length", padded)
        .withColumn("number", F.col("offset") + F.col("before") + F.col("copy"))
        .select(
            "doc_id",
            "piece",
            (F.col("piece").cast("long") * max_length).alias("start_word"),
            "length",
            "bucket",
            "padded_length",
            F.floor(F.col("number") / per_batch).alias("batch"),
            (F.col("number") % per_batch).alias("slot"),
            (F.col("padded_length") - F.col("length")).alias("padding"),
        )
    )


def texts_of(docs: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """doc_id, piece and text (words joined by one space) of every piece."""
    words = words_of(F.col("text"))
    cut = docs.select("doc_id", words.alias("words")).where(F.size("words") > 0)
    last = F.floor((F.size("words") - 1) / max_length).cast("int")
    return cut.select("doc_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("piece")).select(
        "doc_id",
        "piece",
        F.concat_ws(" ", F.slice("words", F.col("piece") * max_length + 1, F.lit(max_length))).alias("text"),
    )
