"""The corpus pipeline: five stages, each one operator over all that is left.

Defined results for odd rows, stage by stage: a null, empty or blank text is
scored, kept or dropped by the classifier like any other; such texts are equal to
each other for both deduplications (one stays), have no words, so the mix takes
nothing of them and nothing of them is packed. A text longer than a batch is
packed in pieces, whole. Of repeated rows one stays. A null doc_id loses to any
other, a null source is a source. An empty table, or a classifier without labels
of both classes, gives what its stages give: an empty result for an empty table.
Columns beyond those of ``documents`` travel along up to the mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import exact_dedup, mixing, near_texts, packing, quality_classifier
from clickloom.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_classifier.keep(docs, table(spark, sf_dir, "labels"))


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    return exact_dedup.deduplicate(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts with 0.8 or more of their five-word shingles in common."""
    return near_texts.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it."""
    return mixing.mixed(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix in token-budget batches."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify_quality),
    ("exact_dedup", dedup_exact),
    ("simhash_near_dedup", dedup_near),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

# A trained classifier, XXH64 fingerprints, the drawn mix and the optimal
# buckets have no SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
