"""Fixtures and helpers of the tests in this folder."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", ".."))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """documents from (doc_id, text[, source]) tuples, over three partitions."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return make


# Null, empty, blank and very long texts, ties, repeated rows, null doc_id and source.
ODD = [
    (1, "one two three four five six seven"),
    (2, None, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r "),
    (5, "one  two\tthree four five six seven"),
    (5, "one  two\tthree four five six seven"),
    (None, "one two three four five six seven"),
    (6, "word " * 50_000),
    (7, "é日本 語 \U0001f600 ÀÉ zz"),
    (7, "another text of the same number", "t"),
]


@pytest.fixture
def odd(make_docs):
    return make_docs(ODD)


@pytest.fixture
def clashing(odd):
    """Extra columns with the names that operators might use inside."""
    from pyspark.sql import functions as F

    extra = ["sha", "maybe", "whole", "row", "key", "size", "print", "score", "hash", "root", "order", "_print"]
    return odd.select("*", *[F.lit(f"x-{c}").alias(c) for c in extra])


def collected(df, *columns):
    """Sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
