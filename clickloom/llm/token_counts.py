"""Token counts by byte-pair merging on a heap and a linked list.

A text is cut at the vocabulary's special strings (each is one token), then
into pieces by the vocabulary's pattern. A piece starts as one symbol a byte;
the adjacent pair of lowest rank is merged, leftmost first, until no pair has a
rank. The count is the symbols at the start minus the merges: no token is ever
named. Counts of pieces are remembered per worker, at most ``REMEMBERED``.

The vocabulary is a file of the tokenizers library; its path is a parameter.
The driver reads it and sends the merge ranks to the workers (50,000 pairs,
whatever the input). Files with a normaliser or another model are refused.

Defined results: a null or empty text has 0 bytes and 0 tokens; all columns but
doc_id and text are ignored; each row gets its row.
"""

from __future__ import annotations

import heapq
import json
import sys
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ship

LIMIT = 512
REMEMBERED = 1_500_000  # pieces in a worker's memory; older ones are counted anew
VOCABULARY = "byte_bpe_50k.json"

# Fixed value: how byte-level vocabularies of this kind cut a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_vocabulary() -> str:
    """Path of the default vocabulary file."""
    if "/opt/tokenizers" not in sys.path:
        sys.path.append("/opt/tokenizers")
    import importlib.util

    spec = importlib.util.spec_from_file_location("public_tokenizers", "/opt/tokenizers/__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.path(VOCABULARY)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary.

    Printable bytes stand for themselves, the others for the characters from
    256 on, in order.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Merge ranks and special strings of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        cutter = content["pre_tokenizer"] or {}
        if (
            content["model"]["type"] != "BPE"
            or content["normalizer"]
            or cutter.get("type") != "ByteLevel"
            or cutter.get("add_prefix_space")
            or not cutter.get("use_regex", True)
        ):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        ids = content["model"]["vocab"]
        self.start = [ids[c] for c in byte_symbols()]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(content["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        added = content["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError(f"{path} has added tokens with options")
        self.special = sorted((t["content"] for t in added), key=len, reverse=True)


def count_merges(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Merges that byte-pair encoding makes on the symbols."""
    n = len(symbols)
    after = list(range(1, n + 1))  # linked list: next and former position
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        found = merges.get((symbols[i], symbols[i + 1]))
        if found:
            heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
    heapq.heapify(heap)
    done = 0
    while heap:
        _, i, left, right, made = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # one of the two has been merged since
        done += 1
        symbols[i], symbols[j] = made, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            found = merges.get((made, symbols[k]))
            if found:
                heapq.heappush(heap, (found[0], i, made, symbols[k], found[1]))
        h = before[i]
        if h >= 0:
            found = merges.get((symbols[h], made))
            if found:
                heapq.heappush(heap, (found[0], h, symbols[h], made, found[1]))
    return done


class Counter(dict):
    """Token count of a piece, remembered."""

    def __init__(self, start: list[int], merges: dict, special: list[str]):
        super().__init__()
        self.start, self.merges = start, merges
        self.cut = regex.compile(PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        symbols = [self.start[b] for b in piece.encode("utf-8", "surrogatepass")]
        size = len(symbols) - (count_merges(symbols, self.merges) if len(symbols) > 1 else 0)
        if len(piece) <= 64:
            self[piece] = size
        return size

    def count(self, text: str) -> int:
        """Tokens of one whole text."""
        if self.special is None:
            return sum(map(self.__getitem__, self.cut(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.cut(part))) for part in parts)


_COUNTERS: dict[str, Counter] = {}  # of this worker, by vocabulary


def _count_batches(path, content, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(*content.value)
    count = _COUNTERS[path].count
    for batch in batches:
        texts = batch.column("text")
        n_tokens = [count(texts[i].as_py() or "") for i in range(len(texts))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n_tokens, pa.int64())],
            ["doc_id", "n_bytes", "n_tokens"],
        )


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    path = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    ship(spark)
    words = Vocabulary(path)
    content = spark.sparkContext.broadcast((words.start, words.merges, words.special))

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    return (
        docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
        .mapInArrow(partial(_count_batches, path, content), f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
