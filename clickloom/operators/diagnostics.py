"""Classifier metrics, thresholds and calibration of a scored dataset.

Inputs carry a 0/1 label (``churned``) and ``churn_probability``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.functions.columns import safe_ratio, share, side_by_side, tally
from clickloom.functions.ladder import area_under_roc, quantile, score_ladder

LABEL = S.TARGET_COLUMN
PROBABILITY = "churn_probability"


def _confusion(predicted: Column) -> list[Column]:
    actual = F.col(LABEL) == 1
    return [
        tally(predicted & actual).alias("tp"),
        tally(predicted & ~actual).alias("fp"),
        tally(~predicted & actual).alias("fn"),
        tally(~predicted & ~actual).alias("tn"),
    ]


def _cells() -> tuple[Column, Column, Column, Column]:
    return F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")


def _f1(hit: Column, wrong: Column, missed: Column) -> Column:
    return safe_ratio(2 * hit, 2 * hit + wrong + missed)


def classification_metrics(scored: DataFrame, cut: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall and F1 of the predicted label (p > cut)."""
    counts = scored.agg(*_confusion(F.col(PROBABILITY) > cut))
    tp, fp, fn, tn = _cells()
    return counts.select(
        safe_ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        _f1(tp, fp, fn).alias("f1_score"),
    )


def roc_auc(scored: DataFrame) -> DataFrame:
    """Exact area under the ROC curve, ties counted half."""
    return score_ladder(scored, PROBABILITY, LABEL).agg(area_under_roc().alias("roc_auc"))


def classification_report(scored: DataFrame, cut: float = 0.5) -> DataFrame:
    """Per-class precision, recall, F1 and support, with accuracy and averages."""
    counts = scored.agg(*_confusion(F.col(PROBABILITY) > cut))
    tp, fp, fn, tn = _cells()
    total = tp + fp + fn + tn
    classes = {
        "0": (safe_ratio(tn, tn + fn), safe_ratio(tn, tn + fp), _f1(tn, fn, fp), tn + fp),
        "1": (safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn), _f1(tp, fp, fn), tp + fn),
    }
    accuracy = safe_ratio(tp + tn, total)

    def line(order: int, name: str, p: Column, r: Column, f: Column, n: Column) -> Column:
        return F.struct(
            F.lit(order).alias("line"),
            F.lit(name).alias("label"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1_score"),
            n.alias("support"),
        )

    zero, one = classes["0"], classes["1"]
    macro = [(a + b) / 2 for a, b in zip(zero[:3], one[:3])]
    weighted = [
        safe_ratio(a * zero[3] + b * one[3], total) for a, b in zip(zero[:3], one[:3])
    ]
    return counts.select(
        F.inline(
            F.array(
                line(1, "0", *zero),
                line(2, "1", *one),
                line(3, "accuracy", accuracy, accuracy, accuracy, total),
                line(4, "macro avg", *macro, total),
                line(5, "weighted avg", *weighted, total),
            )
        )
    )


def threshold_sweep(
    scored: DataFrame, thresholds: tuple[float, ...] = S.THRESHOLDS
) -> DataFrame:
    """Flagged share, accuracy, precision and recall at each cut (p >= cut).

    All thresholds are counted in one pass and unpivoted afterwards; the rows
    are not multiplied by the number of thresholds.
    """
    p, actual = F.col(PROBABILITY), F.col(LABEL) == 1
    counts = scored.agg(
        F.count("*").alias("rows"),
        tally(actual).alias("churned_rows"),
        *[tally(p >= t).alias(f"flagged_{i}") for i, t in enumerate(thresholds)],
        *[tally((p >= t) & actual).alias(f"hits_{i}") for i, t in enumerate(thresholds)],
    )
    per_threshold = counts.select(
        "rows",
        "churned_rows",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(t).alias("threshold"),
                        F.col(f"flagged_{i}").alias("flagged_sessions"),
                        F.col(f"hits_{i}").alias("hits"),
                    )
                    for i, t in enumerate(thresholds)
                ]
            )
        ),
    )
    flagged, hits, rows = F.col("flagged_sessions"), F.col("hits"), F.col("rows")
    # right answers: flagged churners and unflagged others
    right = hits + (rows - F.col("churned_rows")) - (flagged - hits)
    return per_threshold.select(
        "threshold",
        "flagged_sessions",
        share(flagged, rows, None).alias("flagged_percentage"),
        safe_ratio(right, rows).alias("accuracy"),
        safe_ratio(hits, flagged).alias("precision"),
        safe_ratio(hits, F.col("churned_rows")).alias("recall"),
    ).orderBy("threshold")


def high_risk_summary(
    scored: DataFrame, threshold: float = S.HIGH_RISK_THRESHOLD
) -> DataFrame:
    counts = scored.agg(*_confusion(F.col(PROBABILITY) >= threshold))
    tp, fp, fn, tn = _cells()
    return counts.select(
        F.lit(threshold).alias("threshold"),
        (tp + fp).alias("flagged_sessions"),
        share(tp + fp, tp + fp + fn + tn, None).alias("flagged_percentage"),
        tp.alias("true_abandonments"),
        fp.alias("false_positives"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
    )


def brier_score(scored: DataFrame) -> DataFrame:
    error = F.col(PROBABILITY) - F.col(LABEL)
    return scored.agg(F.avg(error * error).alias("brier_score"))


# ----------------------------------------------------------------- calibration
def _edges(bins: int) -> list[float]:
    """Inner and outer edges of equal bins over [0, 1]."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def _binned(scored: DataFrame, bins: int) -> DataFrame:
    """Sessions, mean probability and churn rate of each right-closed bin;
    only bins that hold rows. Probabilities outside [0, 1] belong to no bin."""
    p = F.col(PROBABILITY)
    inner = _edges(bins)[1:-1]
    index = sum((F.when(p > edge, 1).otherwise(0) for edge in inner), start=F.lit(0))
    return (
        scored.where((p >= 0) & (p <= 1))
        .groupBy(index.alias("bin"))
        .agg(
            F.count("*").alias("sessions"),
            (F.avg(p) * 100).alias("average_predicted_probability_pct"),
            (F.avg(LABEL) * 100).alias("actual_churn_rate_pct"),
        )
    )


def calibration_table(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Reliability table; empty bins are kept with 0 sessions."""
    edges = _edges(bins)
    frame = scored.sparkSession.createDataFrame(
        [(i, edges[i], edges[i + 1]) for i in range(bins)],
        "bin int, bin_lower double, bin_upper double",
    )
    gap = F.col("actual_churn_rate_pct") - F.col("average_predicted_probability_pct")
    return (
        frame.join(_binned(scored, bins), "bin", "left")
        .withColumn("sessions", F.coalesce("sessions", F.lit(0)).cast("long"))
        .withColumn("calibration_gap_pct", gap)
        .orderBy("bin")
    )


def calibration_curve(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Curve points of the bins that hold rows."""
    return (
        _binned(scored, bins)
        .orderBy("bin")
        .select("bin", "average_predicted_probability_pct", "actual_churn_rate_pct")
    )


def probability_summary(
    scored: DataFrame, percentiles: tuple[float, ...] = S.SUMMARY_PERCENTILES
) -> DataFrame:
    """Count, mean, standard deviation, exact percentiles and range."""
    moments = scored.agg(
        F.count(PROBABILITY).alias("count"),
        F.avg(PROBABILITY).alias("mean"),
        F.stddev_samp(PROBABILITY).alias("std"),
        F.min(PROBABILITY).alias("min"),
        F.max(PROBABILITY).alias("max"),
    )
    ladder = score_ladder(scored, PROBABILITY, LABEL)
    ranks = ladder.agg(*[quantile(q).alias(f"p{round(q * 100):02d}") for q in percentiles])
    return side_by_side(moments, ranks)
