"""Exact ranks of probabilities without a global sort.

Distinct scores are counted, placed into buckets that hold about equal numbers
of distinct scores, and ranked inside their bucket; the counts below a bucket
come from a summary with one row a bucket. The cut points are quantiles of the
distinct scores, so scores that crowd in a narrow band spread over buckets like
any others. The bucket depends on the score alone; cut points decide how work
is spread and never a rank.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1_024


def _cut_points(steps: DataFrame) -> list[float]:
    """At most ``BUCKETS`` - 1 ascending scores."""
    shares = [i / BUCKETS for i in range(1, BUCKETS)]
    row = steps.where(~F.isnan("score")).agg(
        F.percentile_approx("score", shares, 16 * BUCKETS).alias("cuts")
    )
    return sorted(set(row.first()["cuts"] or []))


def _with_bucket(steps: DataFrame) -> DataFrame:
    """``bucket`` of each score; NaN has the last one for itself."""
    splits = [float("-inf"), *(_cut_points(steps) or [0.5]), float("inf")]
    by_cut = Bucketizer(
        splits=splits, inputCol="score", outputCol="bucket", handleInvalid="keep"
    )
    return by_cut.transform(steps).withColumn("bucket", F.col("bucket").cast("int"))


def score_ladder(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score: rows ``n``, positives ``pos``, how many of
    each lie below it (``n_below``, ``pos_below``), and totals over all."""
    steps = _with_bucket(
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
        )
    )
    below = Window.unboundedPreceding, -1
    in_bucket = Window.partitionBy("bucket").orderBy("score").rowsBetween(*below)
    earlier = Window.orderBy("bucket").rowsBetween(*below)  # one row a bucket
    everything = Window.partitionBy()
    sums = steps.groupBy("bucket").agg(F.sum("n").alias("bn"), F.sum("pos").alias("bpos"))
    offsets = sums.select(
        "bucket",
        F.coalesce(F.sum("bn").over(earlier), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("bpos").over(earlier), F.lit(0)).alias("pos_before"),
        F.sum("bn").over(everything).alias("n_total"),
        F.sum("bpos").over(everything).alias("pos_total"),
    )
    zero = F.lit(0)
    return (
        steps.withColumn("n_in", F.coalesce(F.sum("n").over(in_bucket), zero))
        .withColumn("pos_in", F.coalesce(F.sum("pos").over(in_bucket), zero))
        .join(F.broadcast(offsets), "bucket")  # BUCKETS + 1 rows at most
        .select(
            "score",
            "n",
            "pos",
            (F.col("n_before") + F.col("n_in")).alias("n_below"),
            (F.col("pos_before") + F.col("pos_in")).alias("pos_below"),
            "n_total",
            "pos_total",
        )
    )


def quantile(q: float) -> Column:
    """Aggregate over a ladder: the q-quantile with linear interpolation."""
    position = F.lit(q) * (F.col("n_total") - 1)

    def at(rank: Column) -> Column:
        holds = (F.col("n_below") <= rank) & (rank < F.col("n_below") + F.col("n"))
        return F.max(F.when(holds, F.col("score")))

    low, high = at(F.floor(position)), at(F.ceil(position))
    fraction = F.max(position - F.floor(position))
    return low + (high - low) * fraction


def area_under_roc() -> Column:
    """Aggregate over a ladder: ROC AUC by mid-ranks; NULL for a single class."""
    neg = (F.col("n") - F.col("pos")).cast("double")
    neg_below = (F.col("n_below") - F.col("pos_below")).cast("double")
    wins = F.sum(F.col("pos") * (neg_below + neg / 2))
    pos_total = F.max("pos_total").cast("double")
    neg_total = F.max(F.col("n_total") - F.col("pos_total")).cast("double")
    return F.try_divide(wins, pos_total * neg_total)
