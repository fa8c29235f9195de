"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

A text's features say which n-grams occur in its whole text: words and pairs of
words, and single, paired and tripled word shapes (letters by case, digits,
punctuation; marked when a word repeats the one before), each hashed. The
indicators are scaled by the log of the ratio of their class frequencies and
brought to unit length; a linear hinge-loss model is fitted by dual coordinate
descent. Margins become scores by a logistic fitted to the sample.

Labels and text of a bounded sample (see ``training``) are the only inputs of
the fit, text the only input of a score.

Defined results: a null or empty text has no features and gets the score of the
bias; without labels of both classes every score is 0.5; each row gets its row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ship
from clickloom.llm.training import PER_CLASS, bounded, fold, labelled_sample

FOLDS, HELD_OUT = 3, 1
SHAPES = 1 << 16  # hashed shape n-grams
DIMENSIONS = SHAPES + (1 << 18)  # and hashed word n-grams
REMEMBERED = 1_000_000  # words in a worker's memory
COST, ROUNDS = 1.0, 20

_RUNS = re.compile(r"(.)\1+", re.DOTALL)


def shape(word: str) -> str:
    """Letters by case, digits, other characters themselves; runs shortened."""
    kinds = "".join(
        "a" if c.islower() else "A" if c.isupper() else "9" if c.isdigit() else "x" if c.isalpha() else c
        for c in word
    )
    return _RUNS.sub(lambda m: m[1] if m[1] in "aA9x" else m[1] * 2, kinds)


class Words(dict):
    """Hashes of a word: shape in the upper 31 bits, word in the lower 32."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        kind = shape(word.decode("utf-8", "replace")).encode()
        packed = (xxhash.xxh32_intdigest(kind) >> 1) << 32 | xxhash.xxh32_intdigest(word.lower())
        if len(word) <= 64:
            self[word] = packed
        return packed


_WORDS = Words()  # of this worker


def _mixed(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit hash of the numbers at each place."""
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out = (out ^ part) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of one whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.int32)
    packed = np.fromiter(map(_WORDS.__getitem__, words), np.int64, len(words))
    names = (packed & 0xFFFFFFFF).astype(np.uint64)
    same = np.concatenate(([False], packed[1:] == packed[:-1]))
    kinds = ((packed >> 32) * 2 + same).astype(np.uint64)
    grams = [
        _mixed(*(kinds[i : len(kinds) - n + 1 + i] for i in range(n))) % np.uint64(SHAPES)
        for n in (1, 2, 3)
        if len(kinds) >= n
    ]
    grams += [
        _mixed(*(names[i : len(names) - n + 1 + i] for i in range(n))) % np.uint64(DIMENSIONS - SHAPES)
        + np.uint64(SHAPES)
        for n in (1, 2)
        if len(names) >= n
    ]
    return np.unique(np.concatenate(grams)).astype(np.int32)


def log_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log of the ratio of class frequencies of each feature, smoothed by one."""
    counts = np.ones((2, DIMENSIONS))
    for row, target in zip(rows, y):
        counts[target, row] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_coordinate_descent(rows: list[np.ndarray], scaled: list[np.ndarray], y: np.ndarray):
    """Weights and bias of the hinge-loss model; the bias is a feature of one."""
    signs = np.where(y == 1, 1.0, -1.0)
    cost = COST * len(y) / (2.0 * np.maximum(np.bincount(y, minlength=2), 1))[y]
    weights, bias, alpha = np.zeros(DIMENSIONS), 0.0, np.zeros(len(y))
    squared = np.array([float(v @ v) + 1.0 for v in scaled])
    order = np.random.default_rng(7)
    for _ in range(ROUNDS):
        for i in order.permutation(len(y)):
            gradient = signs[i] * (weights[rows[i]] @ scaled[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / squared[i], 0.0), cost[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                weights[rows[i]] += step * scaled[i]
                bias += step
                alpha[i] = new
    return weights, bias


def logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into scores, by Newton steps."""
    n = np.bincount(y, minlength=2)
    wanted = np.where(y == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    weight = len(y) / (2.0 * np.maximum(n, 1))[y]
    design = np.column_stack([margins, np.ones(len(y))])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (p - wanted)) + 1e-3 * (beta - [1.0, 0.0])
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta -= np.clip(step, -5, 5)
    return max(float(beta[0]), 1e-3), float(beta[1])


def fit(rows: list[np.ndarray], y: np.ndarray) -> dict:
    """Model of a sample: ratios, weights, bias, slope and offset."""
    if len(np.unique(y)) < 2:
        flat = np.zeros(DIMENSIONS, np.float32)
        return {"ratios": flat, "weights": flat, "bias": 0.0, "slope": 1.0, "offset": 0.0}
    ratios = log_ratios(rows, y)
    scaled = [ratios[r] / max(np.linalg.norm(ratios[r]), 1e-12) for r in rows]
    weights, bias = dual_coordinate_descent(rows, scaled, y)
    margins = np.array([weights[r] @ v + bias for r, v in zip(rows, scaled)])
    slope, offset = logistic(margins, y)
    return {
        "ratios": ratios.astype(np.float32),
        "weights": weights.astype(np.float32),
        "bias": float(bias),
        "slope": slope,
        "offset": offset,
    }


def score(model: dict, row: np.ndarray) -> float:
    ratios = model["ratios"][row].astype(float)
    length = float(np.sqrt(ratios @ ratios))
    margin = float(model["weights"][row] @ ratios) / max(length, 1e-12) + model["bias"]
    return float(1 / (1 + np.exp(-np.clip(model["slope"] * margin + model["offset"], -30, 30))))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        rows = pa.array([features(texts[i].as_py()) for i in range(len(texts))], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("target").cast(pa.int32()), rows],
            ["doc_id", "target", "features"],
        )


def _fit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows, y = [], []
    for part in parts:
        rows += [np.asarray(r, np.int32) for r in part["features"]]
        y += part["target"].tolist()
    model = fit(rows, np.asarray(y, np.int64))
    yield pd.DataFrame(
        [{k: v.tobytes() if isinstance(v, np.ndarray) else v for k, v in model.items()}]
    )


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict:
    """Fit on the bounded sample, in one task; the model has a fixed size."""
    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, per_class)
    kind = docs.schema["doc_id"].dataType.simpleString()
    extracted = sample.select("doc_id", "text", "target").mapInArrow(
        _extract, f"doc_id {kind}, target int, features array<int>"
    )
    found = (
        bounded(extracted, per_class)
        .select("target", "features")
        .mapInPandas(_fit, "ratios binary, weights binary, bias double, slope double, offset double")
        .collect()
    )
    if not found:
        return fit([], np.empty(0, np.int64))
    model = found[0].asDict()
    return model | {k: np.frombuffer(bytes(model[k]), np.float32) for k in ("ratios", "weights")}


def _scores(model, texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield pd.Series([score(model.value, features(text)) for text in part], dtype=float)


def scored(docs: DataFrame, model: dict, name: str = "score") -> DataFrame:
    """Documents with their score as column ``name``."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def to_score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return _scores(sent, texts)

    return docs.withColumn(name, to_score(F.col("text")))


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = scored(docs.select("doc_id", "text"), train(docs, labels, per_class))
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    name = "_score" + "_" * max([0, *(len(c) for c in docs.columns)])
    rows = scored(docs, train(docs, labels, per_class), name)
    return rows.where(F.col(name) >= 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])
