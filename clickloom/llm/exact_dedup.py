"""Exact deduplication by two-pass Bloom filtering.

Texts are equal when identical after each run of white space became one space;
a null text counts as empty. The first pass sets two filter positions per text
hash and keeps the positions set at least twice. The second pass holds every
row against that filter: rows that miss it are surely unique and pass straight
through, only the others are shuffled and grouped by their full SHA-256.

The filter has 16 positions per row, at most ``MAX_BITS``; it is the only thing
broadcast, so the broadcast is at most ``MAX_BITS / 64`` words. Beyond about
``MAX_BITS / 16`` rows more unique rows are grouped without need, never fewer.

Defined results: of equal texts the smallest doc_id stays, a null doc_id comes
last; of rows equal in text and doc_id exactly one stays. An empty table gives
an empty result. Column names of the input are free: the working columns of
``deduplicate`` are made so that they clash with none of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import SPACES, stored

MAX_BITS = 1 << 26
BITS_PER_ROW = 16
HOT_SHARE = 1_000  # groups above 1/1000 of the candidates number under 1000


def text_sha256(text: Column) -> Column:
    """Hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "), 256)


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """Size of the filter: a power of two, 16 positions a row, bounded."""
    bits = 1 << 16
    while bits < rows * BITS_PER_ROW and bits < max_bits:
        bits <<= 1
    return bits


def _positions(key: Column, bits: int) -> list[Column]:
    """One position in each half of the filter."""
    half = bits // 2
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(half)) + i * half for i in range(2)]


def set_positions(keys: DataFrame, key: Column, bits: int, least: int = 2) -> DataFrame:
    """First pass: (word, mask) of the positions that ``least`` rows or more set.

    Counts are combined before the shuffle, so a text copied a million times
    sends one row per task.
    """
    places = keys.select(F.explode(F.array(*_positions(key, bits))).alias("place"))
    return (
        places.groupBy("place")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least)
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("mask"))
    )


def maybe_set(rows: DataFrame, key: Column, chosen: DataFrame, bits: int, name: str) -> DataFrame:
    """Second pass: flag ``name`` says whether both positions are in the filter."""
    hits = []
    for i, place in enumerate(_positions(key, bits)):
        word, mask = f"{name}_word{i}", f"{name}_mask{i}"
        side = F.broadcast(chosen.select(F.col("word").alias(word), F.col("mask").alias(mask)))
        rows = rows.join(side, F.shiftright(place, 6) == F.col(word), "left")
        bit = F.getbit(F.col(mask), (place % 64).cast("int"))
        hits.append(F.coalesce(bit == 1, F.lit(False)))
    flagged = rows.withColumn(name, hits[0] & hits[1])
    return flagged.drop(*[f"{name}_{kind}{i}" for i in range(2) for kind in ("word", "mask")])


def mark(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document."""
    keys = stored(
        docs.select(
            "doc_id",
            text_sha256(F.col("text")).alias("sha"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "dedup-keys",
    )
    bits = filter_bits(keys.count(), max_bits)
    twice = stored(set_positions(keys, F.col("sha"), bits), "dedup-filter")
    flagged = maybe_set(keys, F.col("sha"), twice, bits, "maybe")
    unique = flagged.where(~F.col("maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    candidates = flagged.where("maybe").drop("maybe")
    groups = stored(
        candidates.groupBy("sha").agg(
            F.count(F.lit(1)).alias("group_size"),
            F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first"),
        ),
        "dedup-groups",
    )
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    is_hot = F.col("group_size") * HOT_SHARE > total  # under HOT_SHARE groups
    spread = candidates.join(F.broadcast(groups.where(is_hot)), "sha", "left")
    result = F.col("first.doc_id").alias("keep_id"), (F.col("row") == F.col("first.row")).alias("kept")
    hot = spread.where(F.col("group_size").isNotNull()).select("doc_id", "sha", "group_size", *result)
    rest = (
        spread.where(F.col("group_size").isNull())
        .select("doc_id", "sha", "row")
        .join(groups.where(~is_hot), "sha")
        .select("doc_id", "sha", "group_size", *result)
    )
    return unique.unionByName(hot.unionByName(rest).withColumnRenamed("sha", "text_sha256"))


def deduplicate(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows that miss the filter never move; of the others, each task folds its
    copies to one row per text before the shuffle.
    """
    name = "_dedup" + "_" * max([0, *(len(c) for c in docs.columns)])  # longer than any column
    sha, flag = f"{name}_sha", f"{name}_flag"
    keys = stored(docs.select(text_sha256(F.col("text")).alias("sha")), "dedup-keys")
    bits = filter_bits(keys.count(), max_bits)
    twice = stored(set_positions(keys, F.col("sha"), bits), "dedup-filter")
    rows = docs.withColumn(sha, text_sha256(F.col("text")))
    flagged = maybe_set(rows, F.col(sha), twice, bits, flag)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    best = (
        flagged.where(flag)
        .groupBy(sha)
        .agg(F.min_by(whole, F.struct(F.col("doc_id").isNull(), F.col("doc_id"))).alias("whole"))
        .select("whole.*")
    )
    return flagged.where(~F.col(flag)).select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(best)
