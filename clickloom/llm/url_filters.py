"""URL filters on a bit-parallel wildcard automaton.

Glob rules are packed into one bit string: each pattern has a start bit and a
bit for each of its characters. A step reads one character of a URL and moves
all patterns at once, ``D = (D << 1) & B[c] | D & L[c]``: B says which pattern
positions accept the character, L which may stay because a wildcard stands
there. The bit string spans as many 64-bit words as the rules need; the words
of a whole batch of URLs are moved together.

In a glob ``?`` is any one character, ``*`` any run without ``/``, ``**`` any
run. Globs are held against the canonical URL: host, A-Z lower-cased, and path,
without scheme, query and fragment.

A host rule (host, path) fits the host and its subdomains if the path starts
with the rule's; it becomes the globs ``host path **`` and ``*.host path **``.
The longest rule wins (then the longer host). A URL that no host rule fits gets
the verdict of the plain globs: block if one fits, else allow.

Defined results: a null URL or one without ``://`` has empty host and path and
fits no host rule; each row gets its row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ship

# The rules of the registered query.
HOST_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCK_GLOBS = ("spam-farm.**", "*.spam-farm.**", "cheap-pills.**", "*.cheap-pills.**")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


class Automaton:
    """All globs in one multiword Shift-And automaton."""

    def __init__(self, globs: list[str]):
        parsed = [self._parse(glob) for glob in globs]
        used = sorted({"/"} | {c for tokens, _ in parsed for c in tokens if c is not None})
        classes = len(used) + 1  # the last is any character that no glob names
        self.kind = np.full(0x110000, classes - 1, np.uint16)
        for i, c in enumerate(used):
            self.kind[ord(c)] = i
        bits = sum(len(tokens) + 1 for tokens, _ in parsed)
        self.width = max(1, -(-bits // 64))
        accept, stay = [0] * classes, [0] * classes
        start, at = 0, 0
        self.final: list[int] = []
        slash = used.index("/")
        for tokens, loops in parsed:
            start |= 1 << at
            for j, token in enumerate(tokens, 1):
                for c in range(classes):
                    if token is None or (c < len(used) and used[c] == token):
                        accept[c] |= 1 << (at + j)
            for j, over_slash in loops.items():
                for c in range(classes):
                    if over_slash or c != slash:
                        stay[c] |= 1 << (at + j)
            at += len(tokens)
            self.final.append(at)
            at += 1
        self.start = self._words(start)
        self.accept = np.array([self._words(x) for x in accept])
        self.stay = np.array([self._words(x) for x in stay])

    def _words(self, bits: int) -> np.ndarray:
        mask = (1 << 64) - 1
        return np.array([(bits >> (64 * w)) & mask for w in range(self.width)], np.uint64)

    @staticmethod
    def _parse(glob: str) -> tuple[list[str | None], dict[int, bool]]:
        """Characters (None: any) and, by position, wildcards that stay there."""
        tokens: list[str | None] = []
        loops: dict[int, bool] = {}
        i = 0
        while i < len(glob):
            if glob[i] == "*":
                run = len(glob[i:]) - len(glob[i:].lstrip("*"))
                loops[len(tokens)] = loops.get(len(tokens), False) or run > 1
                i += run
            else:
                tokens.append(None if glob[i] == "?" else glob[i])
                i += 1
        return tokens, loops

    def fits(self, texts: list[str]) -> np.ndarray:
        """Which glob (column) fits which whole text (row)."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kind[codes]
        starts = (np.cumsum(lengths) - lengths)[order]
        falling = -lengths[order]
        state = np.tile(self.start, (len(texts), 1))
        for t in range(int(lengths.max(initial=0))):
            n = int(np.searchsorted(falling, -t))  # texts longer than t come first
            c = kinds[starts[:n] + t]
            now = state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.accept[c]) | (now & self.stay[c])
        found = np.empty((len(texts), len(self.final)), bool)
        for p, bit in enumerate(self.final):
            found[order, p] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)
        return found


def _filter(host_rules, block_globs, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ranked = sorted(host_rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    globs = [f"{front}{host}{path}**" for _, host, path in ranked for front in ("", "*.")]
    automaton = Automaton(globs + list(block_globs))
    for batch in batches:
        hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
        found = automaton.fits([h + p for h, p in zip(hosts, paths)])
        by_rule = found[:, : len(globs)].reshape(len(hosts), len(ranked), 2).any(axis=2)
        blocked = found[:, len(globs) :].any(axis=1)
        rules, verdicts = [], []
        for fits, spam in zip(by_rule, blocked):
            best = int(fits.argmax()) if fits.any() else None
            rules.append(None if best is None else ranked[best][1] + ranked[best][2])
            verdicts.append(("block" if spam else "allow") if best is None else ranked[best][0])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("host"),
                batch.column("path"),
                pa.array(rules, pa.string()),
                pa.array(verdicts, pa.string()),
            ],
            ["page_id", "host", "path", "rule", "verdict"],
        )


def filter_urls(
    pages: DataFrame,
    host_rules: tuple[tuple[str, str, str], ...] = HOST_RULES,
    block_globs: tuple[str, ...] = BLOCK_GLOBS,
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    ship(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).mapInArrow(
        partial(_filter, host_rules, block_globs),
        f"page_id {kind}, host string, path string, rule string, verdict string",
    )
