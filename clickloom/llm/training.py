"""Labelled samples for the classifiers of this subpackage.

A classifier is fitted on a bounded sample: ``PER_CLASS`` documents of each
class at most, those with the smallest hash of doc_id. The bound is a parameter
of every fit; scoring always covers all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_CLASS = 3_000


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; a null doc_id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    folds: int,
    held_out: int,
    per_class: int = PER_CLASS,
) -> DataFrame:
    """doc_id, text and target (0 or 1) of the training sample.

    Labels come only from rows outside fold ``held_out``; null labels are no
    labels, and of several labels of one doc_id the largest counts.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .where(fold(F.col("doc_id"), folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max(label).alias("target"))
    )
    order = [F.xxhash64(F.lit(label), "doc_id"), F.col("doc_id")]
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("target") == value).orderBy(*order).limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 x per_class ids, so the broadcast is bounded.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def bounded(sample: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The sample in one task, in a fixed order.

    Repeated doc_ids could make it longer than the ids chosen; the bound holds
    for rows as well.
    """
    return sample.orderBy(F.xxhash64("doc_id", "features"), "target").limit(2 * per_class)
