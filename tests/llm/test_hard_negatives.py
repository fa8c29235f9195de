"""Hard negatives and their residue GEMM against plain integers."""

import math
import random

import numpy as np
import pytest
from llm_cases import collected
from pyspark.sql import functions as F

from clickloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("size", [1, 200, 2**20, 2**29])
@pytest.mark.parametrize("dims", [1, 64, 3000])
def test_scores_are_exact(size, dims):
    rng = np.random.default_rng(size + dims)
    size = min(size, 2**30 // math.isqrt(dims))
    a, b = (rng.integers(-size, size + 1, (n, dims)) for n in (7, 11))
    a[0], b[0], b[1] = size, size, -size  # the largest scores there are
    want = a.astype(object) @ b.T.astype(object)
    primes = hn.primes_for(int(abs(want).max()))
    got = hn.exact_scores(hn.residues(a, primes), hn.residues(b, primes), primes)
    assert (got == want).all()


def brute(rows):
    used = []
    for i, (vec_id, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        used.append((i, vec_id, whole, label))
    out = []
    last = lambda v: (v is None, v or 0)
    for i, anchor, vector, label in used:
        if anchor is None or anchor % 50:
            continue
        score = lambda w: sum(x * y for x, y in zip(vector, w))
        scored = sorted(((score(w), v, l) for j, v, w, l in used if j != i), key=lambda s: (-s[0], last(s[1])))
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p]
            out += [(anchor, positive, k, n, p, q) for k, (q, n, _) in enumerate(fit[:3], 1)]
    return sorted(out, key=repr)


def made(n, dims=8, seed=1, ids=None):
    rng = random.Random(seed)
    kinds = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        k = rng.randrange(4)
        # Few distinct values, so that scores tie.
        vector = [round(4 * (x + rng.gauss(0, 0.4))) / 16 for x in kinds[k]]
        rows.append((ids[i] if ids else i, vector, 9 if k == 3 else k))
    return rows


@pytest.mark.parametrize("cells", [(2048, 8192), (3, 40)])
def test_equals_brute_force(spark, cells):
    rows = made(700)
    got = hn.mine(hn.usable(spark.createDataFrame(rows, SCHEMA).repartition(5)), anchors_a_cell=cells[0], rows_a_cell=cells[1])
    want = brute(rows)
    assert len(want) > 60 and collected(got, *COLUMNS) == want


def test_odd_rows(spark):
    rows = made(150, ids=[i % 120 - 50 for i in range(150)]) + [
        (None, [0.5] * 8, 1),
        (None, None, 1),
        (2**62, [0.25] * 8, 2),
        (50, None, 1),
        (100, [0.1] * 8, None),
        (150, [0.1, None], 1),
        (200, [float("nan")] * 8, 1),
        (250, [0.1, float("-inf")], 1),
        (300, [], 1),
        (350, [1.0], 2),
        (400, [1e-9, -1e-9] * 6, 3),
        (450, [9.0] * 20_000, 3),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for extra in ("row", "place", "named", "slot", "score", "group", "slice", "anchor", "vector", "square", "rank", "found"):
        docs = docs.withColumn(extra, F.lit("x"))
    assert collected(hn.mine(hn.usable(docs)), *COLUMNS) == brute(rows)


def test_small_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hn.mine(hn.usable(none)).count() == 0
    alone = spark.createDataFrame([(50, [1.0], 1), (51, [1.0], 2)], SCHEMA)
    assert hn.mine(hn.usable(alone)).count() == 0


def test_too_large_scores_are_refused(spark):
    rows = [(50, [3e38], 1), (51, [3e38], 1)]
    with pytest.raises(ArithmeticError):
        hn.mine(hn.usable(spark.createDataFrame(rows, SCHEMA)))
    rows = [(50, [2.0**20, 0.0], 1), (51, [2.0**20, 1.0], 1), (52, [2.0**19.5, 3.0], 2)]
    assert collected(hn.mine(hn.usable(spark.createDataFrame(rows, SCHEMA))), *COLUMNS) == brute(rows)
