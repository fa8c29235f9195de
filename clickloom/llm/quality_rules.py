"""Quality rules as a short-circuit cascade.

Each rule rejects a text by exact integer tests on counts of the whole text.
On a sample, every rule is timed alone and its rejections counted; the cascade
asks the rules in falling order of rejections per second and stops at the first
that rejects. A document is kept if no rule rejects it, so the order changes
the cost and never the verdict. The sample has about ``SAMPLE`` documents,
chosen by a hash of doc_id; all documents are judged.

Counts are made at most once a document, when a rule first asks for them.

Defined results: a null or empty text has no words and is rejected as short; a
null doc_id is judged like any other; each row gets its row.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from functools import cached_property, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ship

SAMPLE = 2_000
WINDOW = 8
SYMBOLS = "#*$%&|<>"


class Text:
    """Counts of one whole text, each made when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        # bytes.split() cuts at the six ASCII white-space characters only
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, " \t\n\x0b\x0c\r"))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]

    @cached_property
    def n_lines(self) -> int:
        return len(self.lines)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_marks(self) -> int:
        return self.text.count("!")

    @cached_property
    def n_capitals(self) -> int:
        raw = np.frombuffer(self.text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        return int(((raw >= 65) & (raw <= 90)).sum())

    @cached_property
    def n_same_words(self) -> int:
        """Words equal to the word before them."""
        return sum(a == b for a, b in zip(self.words, self.words[1:]))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in 8-word windows found twice or more in the text.

        Windows get exact numbers by doubling: words to pairs, to fours, to
        eights. A text without a repeated four has no repeated eight.
        """
        if len(self.words) <= WINDOW:
            return 0
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), np.int64, len(self.words))
        span = 1
        while span < WINDOW:
            joined = ids[:-span] * (int(ids.max()) + 1) + ids[span:]
            distinct, ids, counts = np.unique(joined, return_inverse=True, return_counts=True)
            if len(distinct) == len(joined):
                return 0
            span *= 2
        edges = np.zeros(len(self.words) + 1, np.int64)
        starts = np.flatnonzero(counts[ids] > 1)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + WINDOW, -1)
        return int((np.cumsum(edges) > 0).sum())


# Rule -> whether it rejects. ``base`` rules are fixed by the query's contract.
BASE: dict[str, Callable[[Text], bool]] = {
    "short": lambda t: t.n_words < 20,
    "repeated_windows": lambda t: 100 * t.n_repeat_words > 30 * t.n_words,
}
RULES: dict[str, Callable[[Text], bool]] = BASE | {
    "symbols": lambda t: 10 * t.n_symbols > t.n_words,
    "repeated_lines": lambda t: 10 * t.n_dup_lines > 6 * t.n_lines,
    "marks": lambda t: 10 * t.n_marks > t.n_words,
    "capitals": lambda t: 2 * t.n_capitals > t.word_chars,
    "same_words": lambda t: 10 * t.n_same_words > 2 * t.n_words,
    "word_length": lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words,
}


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        spent, rejected = [], []
        for rejects in RULES.values():
            start = time.perf_counter()
            rejected.append(sum(rejects(Text(text)) for text in texts))
            spent.append(time.perf_counter() - start)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(RULES)), pa.array(spent, pa.float64()), pa.array(rejected, pa.int64())],
            ["rule", "seconds", "rejected"],
        )


def order_rules(docs: DataFrame, sample: int = SAMPLE) -> list[str]:
    """Rules by rejections per second on a sample, highest first."""
    ship(docs.sparkSession)
    total = docs.count()
    share = min(1.0, sample / max(total, 1))
    chosen = F.pmod(F.xxhash64(F.lit("rules"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    measured = (
        docs.select("doc_id", "text")
        .where(chosen)
        .select("text")
        .mapInArrow(_measure, "rule string, seconds double, rejected bigint")
        .groupBy("rule")
        .agg((F.sum("rejected") / F.greatest(F.sum("seconds"), F.lit(1e-9))).alias("gain"))
    )
    gains = {r["rule"]: r["gain"] for r in measured.collect()}  # one row a rule
    return sorted(RULES, key=lambda rule: (-gains.get(rule, 0.0), rule))


def rejected_by(text: Text, order: list[str]) -> str | None:
    """First rule of the cascade that rejects the text."""
    return next((rule for rule in order if RULES[rule](text)), None)


def _judge(order: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rules = json.loads(order)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for batch in batches:
        texts = batch.column("text")
        columns: dict[str, list] = {name: [] for name in (*counts, "base_failed", "kept")}
        for i in range(len(texts)):
            text = Text(texts[i].as_py())
            columns["kept"].append(rejected_by(text, rules) is None)
            columns["base_failed"].append(any(rejects(text) for rejects in BASE.values()))
            for name in counts:
                columns[name].append(getattr(text, name))
        kinds = {"base_failed": pa.bool_(), "kept": pa.bool_()}
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(v, kinds.get(k, pa.int64())) for k, v in columns.items())],
            ["doc_id", *columns],
        )


def judge(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Counts, base_failed and kept of every document."""
    order = json.dumps(order_rules(docs, sample))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        partial(_judge, order),
        f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean",
    )


def _passes(rules: list[str], texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield pd.Series([rejected_by(Text(text), rules) is None for text in part], dtype=bool)


def keep(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    rules = order_rules(docs, sample)

    @F.pandas_udf("boolean")
    def passes(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return _passes(rules, texts)

    return docs.where(passes(F.col("text")))
