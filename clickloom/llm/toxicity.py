"""Toxicity: a factorization machine over hashed terms.

A text's terms are its distinct words, lower-cased and without punctuation at
either end, and their beginnings of 4, 5 and 6 letters, each hashed. The terms
that tell the classes apart best on the training sample (by a likelihood-ratio
statistic) enter the model, and with them the terms of pairs that tell more
together than both alone, if a fit with them does better on rows held back from
the sample; what is admitted is bounded by ``Limits``, a parameter of the fit,

    w0 + sum w[i] + sum over pairs <v[i], v[j]>,

so a pair of terms, such as an insult and the mention of a group, can weigh
more or less than its two words. Weights are fitted to the log loss by Adam with
a falling rate. Three times in four a text shows only a random part of its terms,
so one insult in a long text is not outvoted by all that stands around it.

Labels and text of a bounded sample (see ``training``) are the only inputs of
the fit, text the only input of a score; whole texts are read in both.

Defined results: a null or empty text has no terms and gets the score of w0;
without labels of both classes every score is 0; each row gets its row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ship
from clickloom.llm.training import PER_CLASS, bounded, fold, labelled_sample

FOLDS, HELD_OUT = 5, 0
DIMENSIONS = 1 << 22  # hashed terms
PAIRS_AT_ONCE = 256  # terms whose pairs are counted together
HELD_BACK = 4  # one row in so many decides whether pairs enter
STARTS = (4, 5, 6)
FACTORS = 8
ROUNDS, BATCH, RATE, DECAY = 20, 64, 0.02, 3e-4
WHOLE = 0.25  # share of the texts that show all their terms in a round
REMEMBERED = 1_000_000  # words in a worker's memory
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…¿¡"


@dataclass(frozen=True)
class Limits:
    """What may enter the machine."""

    terms: int = 4_096  # terms that tell alone, and again of telling pairs
    least_docs: int = 3  # training documents a term must be in
    least_gain: float = 10.0  # nats that a term must tell about the classes
    least_pair_gain: float = 20.0  # nats that a pair must tell beyond its two terms; 16 are ln of all pairs
    pair_terms: int = 8_192  # most frequent terms whose pairs are counted
    partners: int = 3  # pairs of one term


def terms(word: bytes) -> tuple[int, ...]:
    """Hashed terms of one word."""
    clean = word.decode("utf-8", "replace").strip(EDGES).lower()
    if not clean:
        return ()
    names = [clean] + [f"{clean[:n]}*" for n in STARTS if len(clean) >= n]
    return tuple(xxhash.xxh32_intdigest(n.encode()) % DIMENSIONS for n in names)


class Terms(dict):
    """Terms of a word that are in the vocabulary, by their numbers."""

    def __init__(self, vocabulary: dict[int, int] | None = None):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = terms(word)
        if self.vocabulary is not None:
            found = tuple(self.vocabulary[t] for t in found if t in self.vocabulary)
        if len(word) <= 64:
            self[word] = found
        return found

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct terms of one whole text."""
        found: set[int] = set()
        for word in set((text or "").encode("utf-8", "surrogatepass").split()):
            found.update(self[word])
        return np.array(sorted(found), np.int32)


def _gain(cells: list[tuple[np.ndarray, np.ndarray]], n: np.ndarray) -> np.ndarray:
    """Likelihood-ratio statistic of the classes in cells of (class 0, class 1) counts."""
    gain = 0.0
    for cell in cells:
        total = cell[0] + cell[1]
        for c in (0, 1):
            share = total * (n[c] / n.sum())
            gain = gain + np.where(cell[c] > 0, cell[c] * np.log(np.maximum(cell[c], 1e-9) / np.maximum(share, 1e-9)), 0)
    return gain


def telling_pairs(
    rows: list[np.ndarray], y: np.ndarray, with_term: np.ndarray, limits: Limits
) -> list[tuple[int, int]]:
    """Pairs that tell ``least_pair_gain`` beyond what both terms tell, the best first.

    Taken one by one while both terms have fewer than ``partners``: a term that
    goes with whatever marks its language or topic does not let all of that in.
    A document tells ln(n / n of its class) at most, so rarer terms have no such pair.
    """
    n = np.bincount(y, minlength=2).astype(float)
    count = with_term.sum(axis=0)
    able = np.flatnonzero((count >= limits.least_pair_gain / np.log(n.sum() / n.min())) & (count < n.sum()))
    able = np.sort(able[np.lexsort((able, -count[able]))[: limits.pair_terms]])
    if len(able) < 2:
        return []
    place = np.full(DIMENSIONS, -1, np.int32)
    place[able] = np.arange(len(able))
    sides = [np.zeros((int(m), len(able)), np.float32) for m in n]
    filled = [0, 0]
    for row, target in zip(rows, y):
        at = place[row]
        sides[target][filled[target], at[at >= 0]] = 1
        filled[target] += 1
    one = [with_term[c, able].astype(float) for c in (0, 1)]
    alone = _gain([tuple(one), tuple(n[c] - one[c] for c in (0, 1))], n)
    candidates = []
    for at in range(0, len(able), PAIRS_AT_ONCE):
        part = slice(at, at + PAIRS_AT_ONCE)
        both = [(side[:, part].T @ side).astype(float) for side in sides]
        left, right = [o[part, None] for o in one], [o[None, :] for o in one]
        cells = [
            tuple(both),
            tuple(left[c] - both[c] for c in (0, 1)),
            tuple(right[c] - both[c] for c in (0, 1)),
            tuple(n[c] - left[c] - right[c] + both[c] for c in (0, 1)),
        ]
        more = _gain(cells, n) - alone[part, None] - alone[None, :]
        for i, gains in enumerate(more, at):
            gains[i] = -np.inf
            nearest = np.argpartition(-gains, min(limits.partners, len(able) - 1))[: limits.partners + 1]
            candidates += [(-gains[j], min(i, j), max(i, j)) for j in nearest if gains[j] >= limits.least_pair_gain]
    partners, pairs = np.zeros(len(able), int), []
    for _, i, j in sorted(set(candidates)):
        if max(partners[i], partners[j]) < limits.partners:
            partners[[i, j]] += 1
            pairs.append((int(able[i]), int(able[j])))
    return pairs


def choose_terms(rows: list[np.ndarray], y: np.ndarray, limits: Limits = Limits()) -> tuple[np.ndarray, np.ndarray]:
    """Terms that tell alone, and the further terms of telling pairs."""
    n = np.bincount(y, minlength=2).astype(float)
    with_term = np.zeros((2, DIMENSIONS), np.int32)
    for row, target in zip(rows, y):
        with_term[target, row] += 1
    frequent = np.flatnonzero(with_term.sum(axis=0) >= limits.least_docs)
    a = with_term[:, frequent].astype(float)
    gain = _gain([tuple(a), tuple(n[c] - a[c] for c in (0, 1))], n)
    best = np.lexsort((frequent, -gain))[: limits.terms]
    alone = np.sort(frequent[best[gain[best] >= limits.least_gain]])
    in_pairs = np.array(telling_pairs(rows, y, with_term, limits), np.int64).ravel()
    _, first = np.unique(in_pairs, return_index=True)
    further = [t for t in in_pairs[np.sort(first)].tolist() if t not in set(alone.tolist())]
    return alone.astype(np.int32), np.sort(np.array(further[: limits.terms], np.int32))


def raw(model: dict, row: np.ndarray) -> float:
    """The machine's value for a set of terms."""
    v = model["v"][row]
    total = v.sum(axis=0)
    return float(model["w0"] + model["w"][row].sum() + 0.5 * (total @ total - (v * v).sum()))


def _learn(rows: list[np.ndarray], y: np.ndarray, chosen: np.ndarray) -> dict:
    """w0, w and v of the chosen terms; classes weigh alike."""
    rows = [np.searchsorted(chosen, np.intersect1d(r, chosen)) for r in rows]
    rng = np.random.default_rng(11)
    state = {
        "w0": np.zeros(1),
        "w": np.zeros(len(chosen)),
        "v": rng.normal(0, 0.02, (len(chosen), FACTORS)),
    }
    first = {k: np.zeros_like(v) for k, v in state.items()}
    second = {k: np.zeros_like(v) for k, v in state.items()}
    weight = len(y) / (2.0 * np.bincount(y, minlength=2))[y]
    step, steps = 0, ROUNDS * -(-len(y) // BATCH)
    for _ in range(ROUNDS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            part = order[at : at + BATCH]
            shown = [
                rows[i] if rng.random() < WHOLE else rows[i][rng.random(len(rows[i])) < rng.random()] for i in part
            ]
            flat = np.concatenate(shown)
            owner = np.repeat(np.arange(len(part)), [len(r) for r in shown])
            v = state["v"][flat]
            total = np.zeros((len(part), FACTORS))
            np.add.at(total, owner, v)
            linear = np.bincount(owner, state["w"][flat], len(part))
            squares = np.bincount(owner, (v * v).sum(axis=1), len(part))
            value = state["w0"][0] + linear + 0.5 * ((total * total).sum(axis=1) - squares)
            miss = weight[part] * (1 / (1 + np.exp(-np.clip(value, -30, 30))) - y[part]) / len(part)
            slope = {k: DECAY * x for k, x in state.items()}
            slope["w0"] += miss.sum()
            slope["w"] += np.bincount(flat, miss[owner], len(chosen))
            np.add.at(slope["v"], flat, miss[owner][:, None] * (total[owner] - v))
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for k in state:
                first[k] = 0.9 * first[k] + 0.1 * slope[k]
                second[k] = 0.999 * second[k] + 0.001 * slope[k] ** 2
                state[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return {"terms": chosen, "w0": float(state["w0"][0]), "w": state["w"], "v": state["v"]}


def log_loss(model: dict, rows: list[np.ndarray], y: np.ndarray) -> float:
    """Mean log loss, classes weighing alike."""
    weight = len(y) / (2.0 * np.maximum(np.bincount(y, minlength=2), 1))[y]
    value = [raw(model, np.searchsorted(model["terms"], np.intersect1d(r, model["terms"]))) for r in rows]
    value = np.clip(value, -30, 30) * np.where(y == 1, 1, -1)
    return float((weight * np.log1p(np.exp(-value))).mean())


def fit(rows: list[np.ndarray], y: np.ndarray, limits: Limits = Limits()) -> dict:
    """Terms, w0, w and v fitted to the sample.

    Terms of pairs enter if, fitted to three rows in four, the machine with them
    has a smaller log loss on the fourth than the one without.
    """
    if len(np.unique(y)) < 2:
        none = np.empty(0, np.int32)
        return {"terms": none, "w0": -30.0, "w": np.zeros(0), "v": np.zeros((0, FACTORS))}
    alone, further = choose_terms(rows, y, limits)
    chosen = alone
    if len(further):
        held = np.zeros(len(y), bool)
        for target in (0, 1):  # in the order of the sample, of each class alike
            held[np.flatnonzero(y == target)[:: HELD_BACK]] = True
        part, rest = ([r for r, h in zip(rows, held) if h == side] for side in (False, True))
        both = np.union1d(alone, further)
        losses = [log_loss(_learn(part, y[~held], terms), rest, y[held]) for terms in (alone, both)]
        chosen = both if losses[1] < losses[0] else alone
    return _learn(rows, y, chosen)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    all_terms = Terms()
    for batch in batches:
        texts = batch.column("text")
        rows = pa.array([all_terms.of(texts[i].as_py()) for i in range(len(texts))], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("target").cast(pa.int32()), rows],
            ["doc_id", "target", "features"],
        )


def _fitted(limits: Limits):
    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, y = [], []
        for part in parts:
            rows += [np.asarray(r, np.int32) for r in part["features"]]
            y += part["target"].tolist()
        model = fit(rows, np.asarray(y, np.int64), limits)
        yield pd.DataFrame(
            [
                {
                    "terms": model["terms"].astype(np.int32).tobytes(),
                    "w0": model["w0"],
                    "w": model["w"].astype(float).tobytes(),
                    "v": model["v"].astype(float).tobytes(),
                }
            ]
        )

    return work


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, limits: Limits = Limits()) -> dict:
    """Fit on the bounded sample, in one task; the model has a fixed size."""
    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, per_class)
    kind = docs.schema["doc_id"].dataType.simpleString()
    extracted = sample.select("doc_id", "text", "target").mapInArrow(
        _extract, f"doc_id {kind}, target int, features array<int>"
    )
    found = (
        bounded(extracted, per_class)
        .select("target", "features")
        .mapInPandas(_fitted(limits), "terms binary, w0 double, w binary, v binary")
        .collect()
    )
    if not found:
        return fit([], np.empty(0, np.int64))
    row = found[0]
    return {
        "terms": np.frombuffer(bytes(row["terms"]), np.int32),
        "w0": row["w0"],
        "w": np.frombuffer(bytes(row["w"]), float),
        "v": np.frombuffer(bytes(row["v"]), float).reshape(-1, FACTORS),
    }


def score(model: dict, row: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(raw(model, row), -30, 30))))


def _scores(model, texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    known = Terms({int(t): i for i, t in enumerate(model.value["terms"])})
    for part in texts:
        yield pd.Series([score(model.value, known.of(text)) for text in part], dtype=float)


def classify(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, limits: Limits = Limits()
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class, limits))

    @F.pandas_udf("double")
    def to_score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return _scores(sent, texts)

    rows = docs.select("doc_id", to_score(F.col("text")).alias("score"))
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
