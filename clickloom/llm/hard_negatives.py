"""Hard negatives: exact integer scores by a residue-number-system GEMM.

Vectors are integers, scores their inner products. A float32 matrix product is
exact only below 2^24, so the integer matrices are reduced modulo several small
primes to balanced residues; each residue product is a float32 GEMM that stays
exact (longer vectors are multiplied in pieces that do), and the signed score
comes back by Chinese remaindering: balanced mixed-radix digits, which are
unique for every score up to half the product of the primes. How many primes
are needed follows from the largest norms in the table, so every score is exact.

Anchors are held against all rows in blocks: a grid of anchor groups and row
slices, both of bounded size by hash, meets group by group; each cell gives a
few rows an anchor, which a window over each anchor folds. Two passes: the
first finds each anchor's positives, the second the best rows of other labels
inside the window of scores that each positive opens.

Defined results: rows with a null label, a null vector or any null or
non-finite component take no part; a vector shorter than another one counts as
filled with zeros, and an empty one scores 0; ties go to the smaller vec_id, a
null vec_id comes last; repeated rows are rows of their own, and each repeated
anchor row gets its rows; anchors without a positive and positives without a
negative in their window give no row; an empty table gives an empty result.
Scores that may not fit a long end the query with an ArithmeticError. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import ship, stored

POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95  # percent of the positive's score
SCALE = 256
ANCHORS_A_CELL, ROWS_A_CELL = 2_048, 8_192  # largest block, about
LEAST_ROWS_A_CELL = 256  # smaller tables fill the cores with smaller blocks
SCORES_AT_ONCE = 1 << 20
EXACT = 1 << 24  # integers up to here are exact in float32
LAST_ID = np.iinfo(np.int64).max
NEVER = np.iinfo(np.int64).min


def primes_below(limit: int = 256) -> list[int]:
    """Odd primes below ``limit``, the largest first."""
    return [n for n in range(limit - 1, 2, -1) if all(n % d for d in range(2, math.isqrt(n) + 1))]


def primes_for(bound: int) -> list[int]:
    """Primes whose product tells all integers from -bound to bound apart."""
    chosen, product = [], 1
    for p in primes_below():
        if product > 2 * bound:
            break
        chosen.append(p)
        product *= p
    return chosen


def _balanced(values: np.ndarray, p: int) -> np.ndarray:
    """Residues from -(p - 1) / 2 to (p - 1) / 2."""
    half = p // 2
    return (values + half) % p - half


def residues(m: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The matrix modulo each prime, in float32."""
    return [_balanced(m, p).astype(np.float32) for p in primes]


def residue_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p, balanced, of residues; every float32 product is exact."""
    piece = EXACT // (p // 2) ** 2  # so many products of residues stay exact
    total = np.zeros((len(a), len(b)), np.int64)
    for at in range(0, a.shape[1], piece):
        total += (a[:, at : at + piece] @ b[:, at : at + piece].T).astype(np.int64)
    return _balanced(total, p)


def exact_scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """a @ b.T from the residues of both, exact within half the product of the primes."""
    digits = [residue_product(a[0], b[0], primes[0])]
    score, weight = digits[0].astype(np.uint64), 1  # what overflows on the way cancels modulo 2^64
    for i, p in enumerate(primes[1:], 1):
        known, radix = np.zeros_like(digits[0]), 1
        for digit, q in zip(digits, primes):
            known += digit * radix
            radix = radix * q % p
        digits.append(_balanced((residue_product(a[i], b[i], p) - known) * pow(radix, -1, p), p))
        weight = weight * primes[i - 1] % (1 << 64)
        score += digits[-1].astype(np.uint64) * np.uint64(weight)
    return score.astype(np.int64)


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the k largest scores of each row, the first column first in ties.

    ``NEVER`` marks what is not to be chosen; ``scores`` is used up.
    """
    rows, columns = [], []
    every = np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        top = scores.argmax(axis=1)
        there = scores[every, top] != NEVER
        rows.append(every[there])
        columns.append(top[there])
        scores[every, top] = NEVER
    return np.concatenate([*rows, every[:0]]), np.concatenate([*columns, every[:0]])


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part: vec_id, label, vector (of longs), anchor, square (no less than its norm's).

    The query's reading of ``embeddings``: a component x is floor(SCALE * x), a
    row whose vec_id is divisible by 7 has the next label, one divisible by 50
    is an anchor.
    """
    whole = F.col("embedding").cast("array<double>")
    fit = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    flipped = F.coalesce(vec_id % 7 == 0, F.lit(False))
    return vectors.where(F.col("label").isNotNull() & F.forall(whole, fit)).select(
        vec_id.alias("vec_id"),
        F.when(flipped, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform(whole, lambda x: F.floor(x * SCALE)).alias("vector"),
        F.coalesce(vec_id % 50 == 0, F.lit(False)).alias("anchor"),
        # Of the unrounded components: floors of huge ones saturate, these do not.
        F.aggregate(whole, F.lit(0.0), lambda a, x: a + F.pow(F.abs(x * SCALE) + 1, 2)).alias("square"),
    )


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _cell(primes: list[int], dims: int, choose: Callable):
    """One cell of the grid: scores of a group of anchors and a slice of rows, and what is chosen."""

    def work(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "named", "row"], ascending=[True, False, True], ignore_index=True)
        right, found = residues(_matrix(rows["vector"], dims), primes), [_found(anchors[:0], rows, None, None, 0)]
        for at in range(0, len(anchors) if len(rows) else 0, max(1, SCORES_AT_ONCE // max(1, len(rows)))):
            part = anchors[at : at + max(1, SCORES_AT_ONCE // len(rows))]
            scores = exact_scores(residues(_matrix(part["vector"], dims), primes), right, primes)
            same = part["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :]
            found += choose(part, rows, scores, same)
        return pd.concat(found, ignore_index=True)

    return work


def _found(anchors: pd.DataFrame, rows: pd.DataFrame, scores: np.ndarray | None, at: tuple | None, slot: int) -> pd.DataFrame:
    a, r = at or (np.empty(0, int), np.empty(0, int))
    return pd.DataFrame(
        {
            "anchor": anchors["row"].to_numpy()[a],
            "slot": np.full(len(a), slot, np.int32),
            **{c: rows[c].to_numpy()[r] for c in ("row", "place", "named")},
            "score": np.empty(0, np.int64) if scores is None else scores[a, r],
        }
    )


def _choose_positives(k: int):
    def choose(anchors, rows, scores, same):
        same &= anchors["row"].to_numpy()[:, None] != rows["row"].to_numpy()[None, :]
        return [_found(anchors, rows, scores, best(np.where(same, scores, NEVER), k), 0)]

    return choose


def _choose_negatives(k: int):
    def choose(anchors, rows, scores, same):
        other, found = np.where(same, NEVER, scores), []
        for slot in range(anchors["lows"].map(len).max()):
            # An anchor without this positive has an empty window.
            low = np.array([x[slot] if slot < len(x) else 1 for x in anchors["lows"]], np.int64)[:, None]
            high = np.array([x[slot] if slot < len(x) else 0 for x in anchors["highs"]], np.int64)[:, None]
            inside = np.where((other >= low) & (other <= high), other, NEVER)
            found.append(_found(anchors, rows, scores, best(inside, k), slot + 1))
        return found

    return choose


def _grid(anchors: DataFrame, rows: DataFrame, groups: int, slices: int, work: Callable) -> DataFrame:
    """What ``work`` finds in all cells, each a group of bounded size."""
    group = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")
    piece = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(slices)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # By number, as a cell's work does not show in its bytes.
    tasks = min(groups * slices, 8 * rows.sparkSession.sparkContext.defaultParallelism)
    left, right = (
        side.repartition(tasks, "group", "slice").groupBy("group", "slice")
        for side in (
            anchors.withColumn("group", group).withColumn("slice", every(slices)),
            rows.withColumn("slice", piece).withColumn("group", every(groups)),
        )
    )
    return left.cogroup(right).applyInPandas(
        work, "anchor long, slot int, row long, place long, named boolean, score long"
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The first k of each anchor and slot over all slices; each task keeps only its own first k."""
    order = [F.desc("score"), F.asc("place"), F.desc("named"), F.asc("row")]
    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _percent_of(score: Column, percent: int, up: bool) -> Column:
    """percent * score / 100, rounded up or down, without overflow."""
    rest = F.pmod(score, F.lit(100))
    hundreds = F.call_function("div", score - rest, F.lit(100))
    return hundreds * percent + F.call_function("div", rest * percent + (99 if up else 0), F.lit(100))


def mine(
    vectors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    anchors_a_cell: int = ANCHORS_A_CELL,
    rows_a_cell: int = ROWS_A_CELL,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores, from rows as ``usable`` gives them.

    A negative's score lies from ``least`` to ``most`` percent of the positive's.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = stored(vectors.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    known = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("anchor").alias("anchors"),
        F.max(F.size("vector")).alias("dims"),
        F.max("square").alias("square"),
        F.max(F.when(F.col("anchor"), F.col("square"))).alias("anchor_square"),
    ).first()
    bound = 1.001 * math.sqrt(known["square"] or 0) * math.sqrt(known["anchor_square"] or 0) + 1
    if not bound < 2**62:
        raise ArithmeticError("scores of these vectors may not fit a long")
    primes, dims = primes_for(int(bound)), known["dims"] or 0
    groups = max(1, -(-known["anchors"] // anchors_a_cell))
    filling = min(4 * spark.sparkContext.defaultParallelism, -(-known["rows"] // LEAST_ROWS_A_CELL))
    slices = max(1, -(-known["rows"] // rows_a_cell), filling // groups)
    anchors = rows.where("anchor")
    named = F.col("vec_id").isNotNull().alias("named")
    rows = rows.select("row", F.coalesce("vec_id", F.lit(LAST_ID)).alias("place"), named, "label", "vector")
    first = _grid(
        anchors.select("row", "label", "vector"), rows, groups, slices, _cell(primes, dims, _choose_positives(positives))
    )
    chosen = stored(_ranked(first, positives), "negatives-positives")
    windows = chosen.groupBy(F.col("anchor").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("rank", F.when(F.col("named"), F.col("place")).alias("id"), "score"))).alias("found")
    )
    opened = stored(anchors.join(windows, "row").select("row", "vec_id", "label", "vector", "found"), "negatives-windows")
    scores = F.transform("found", lambda x: x["score"])
    second = _grid(
        opened.select("row", "label", "vector", scores.alias("scores")).select(
            "row",
            "label",
            "vector",
            F.transform("scores", lambda x: _percent_of(x, least, True)).alias("lows"),
            F.transform("scores", lambda x: _percent_of(x, most, False)).alias("highs"),
        ),
        rows,
        groups,
        slices,
        _cell(primes, dims, _choose_negatives(negatives)),
    )
    found = _ranked(second, negatives)
    positive = opened.select(
        F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.posexplode("found").alias("at", "positive")
    ).withColumn("slot", F.col("at") + 1)
    return found.join(positive, ["anchor", "slot"]).select(
        "anchor_id",
        F.col("positive.id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.when(F.col("named"), F.col("place")).alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
