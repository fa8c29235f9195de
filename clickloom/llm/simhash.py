"""SimHash near-duplicates: pigeonhole blocks, Hamming check, components.

The fingerprint sums the bits of the XXH64 (seed 42) of a text's 3-word
shingles. Fingerprints link at ``DISTANCE`` or fewer differing bits. 64 bits
are cut into ``BLOCKS`` blocks; two linked fingerprints agree in at least
BLOCKS - DISTANCE of them, so they meet under one of the keys made of so many
blocks. Only distinct fingerprints are joined: copies never make pairs.

A key shared by more than ``CROWD`` distinct fingerprints would make pairs with
the square of their number. Those fingerprints go another exact way, linear in
their number: two of them link exactly if some 64-bit value lies at most one
bit from one and at most two bits from the other, so every value is linked to
its members in a star instead of all pairs.

Components are found over distinct fingerprints by alternating large-star and
small-star steps, each written to the shared folder; nothing goes to the driver
but counts.

Defined results: a null or empty text has fingerprint zero, which links like
any other; a null doc_id is in a component but never names it while a known
doc_id is there; repeated rows each get their row; an empty table an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ship, stored
from clickloom.llm.exact_dedup import filter_bits, maybe_set, set_positions

SHINGLE = 3
SEED = 42
DISTANCE = 3
BLOCKS = 6  # keys of 3 blocks, 31 to 33 bits; 20 keys a fingerprint
CROWD = 128
HOT_SHARE = 1_000
BITS_AT_ONCE = 4096  # shingles whose bits are unpacked together

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))  # A-Z only
_SPACE = bytes([9, 10, 11, 12, 13, 32])


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of one whole text."""
    # Bytes split at the six ASCII white-space characters, never inside UTF-8.
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(SHINGLE, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (
            digest(joined[a:b], SEED)
            for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
        ),
        dtype="<u8",
        count=len(words) - width + 1,
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BITS_AT_ONCE):
        part = hashes[at : at + BITS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * ones > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        prints = np.fromiter(
            (fingerprint(texts[i].as_py()) for i in range(len(texts))), dtype=np.uint64, count=len(texts)
        ).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "print"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and print (the fingerprint's bits as a signed long)."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, f"doc_id {kind}, print bigint")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _keys(value: Column) -> Column:
    """Array of the keys of a fingerprint: which blocks, and their bits."""
    edges = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    keys = []
    for i, blocks in enumerate(combinations(range(BLOCKS), BLOCKS - DISTANCE)):
        mask = sum(masks[b] for b in blocks)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(
            F.struct(F.lit(i).cast("byte").alias("part"), value.bitwiseAND(F.lit(signed).cast("long")).alias("bits"))
        )
    return F.array(*keys)


def _near(value: Column, flips: int) -> Column:
    """All 64-bit values that differ from ``value`` in at most ``flips`` bits."""
    one = "transform(sequence(0, 63), i -> shiftleft(1L, i))"
    near = F.array_append(F.expr(one), F.lit(0).cast("long"))
    if flips == 2:
        pairs = "flatten(transform(sequence(0, 62), i -> transform(sequence(i + 1, 63), j -> shiftleft(1L, i) | shiftleft(1L, j))))"
        near = F.concat(near, F.expr(pairs))
    return F.transform(near, lambda mask: value.bitwiseXOR(mask))


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all linked ones."""
    keyed = stored(
        prints.select("print", F.explode(_keys(F.col("print"))).alias("key")).select("print", "key.*"),
        "simhash-keys",
    )
    sizes = keyed.groupBy("part", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = stored(sizes, "simhash-sizes")
    shared = sizes.where(F.col("n") <= CROWD)
    left = keyed.join(shared, ["part", "bits"]).select("part", "bits", F.col("print").alias("a"))
    right = keyed.join(shared, ["part", "bits"]).select("part", "bits", F.col("print").alias("b"))
    pairs = (
        left.join(right, ["part", "bits"])
        .where((F.col("a") < F.col("b")) & (_distance(F.col("a"), F.col("b")) <= DISTANCE))
        .select("a", "b")
    )
    crowds = sizes.where(F.col("n") > CROWD)
    if crowds.isEmpty():
        return pairs.distinct()
    crowded = stored(
        keyed.join(crowds, ["part", "bits"], "left_semi").select("print").distinct(), "simhash-crowded"
    )
    centres = (
        crowded.select("print", F.explode(_near(F.col("print"), 1)).alias("value"))
        .groupBy("value")
        .agg(F.min("print").alias("a"))
    )
    stars = (
        crowded.select(F.col("print").alias("b"), F.explode(_near(F.col("print"), 2)).alias("value"))
        .join(centres, "value")
        .where("a <> b")
        .select("a", "b")
    )
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (smallest node reachable) of every node on an edge.

    Large star: each node's larger neighbours join its smallest one. Small star:
    a node and its smaller neighbours join the smallest. Repeated until stable;
    the number of rounds grows with the logarithm of the longest path.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = stored(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "small-star")
        moved = small.join(edges, ["a", "b"], "left_anti")
        if small.count() == edges.count() and moved.isEmpty():
            return small.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = small


def members_of(rows: DataFrame) -> DataFrame:
    """print, root, component_id and rows of the component, one row a print."""
    prints = stored(
        rows.groupBy("print").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")),
        "simhash-prints",
    )
    roots = stored(components(links(prints.select("print"))), "simhash-roots")
    linked = prints.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "first", "n", F.coalesce("root", "print").alias("root")
    )
    named = linked.groupBy("root").agg(
        F.min("first").alias("component_id"), F.sum("n").alias("n_rows")
    )
    return stored(
        linked.join(named, "root").select("print", "root", "component_id", "n_rows"),
        "simhash-members",
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    rows = stored(fingerprints(docs), "simhash")
    members = members_of(rows).select("print", "component_id")
    return _spread(rows, members).select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _spread(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Rows with the component of their fingerprint.

    Fingerprints on more than 1/1000 of the rows (so fewer than 1000) are
    joined by a broadcast, all others by a shuffle.
    """
    total = rows.count()
    hot = rows.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * HOT_SHARE > total)
    hot = stored(hot.join(members, "print").select("print", "component_id"), "simhash-hot")
    marked = rows.join(F.broadcast(hot), "print", "left")
    frequent = marked.where("component_id IS NOT NULL OR print IS NULL")
    rest = marked.where("component_id IS NULL AND print IS NOT NULL").drop("component_id")
    return frequent.unionByName(rest.join(members, "print"))


def one_a_component(rows: DataFrame, key: str, shared: DataFrame, columns: list[str]) -> DataFrame:
    """Of ``rows``, one of each component, with ``columns``: the smallest doc_id.

    ``shared`` (key, root) has the keys of the components with several rows.
    Rows alone in their component never move: a filter over those keys, bounded
    like that of the exact operator, lets them pass. The rest is folded to one
    row a key, then to one a component, both before each shuffle. Of rows equal
    in doc_id and key one stays.
    """
    bits = filter_bits(shared.count())
    present = stored(set_positions(shared, F.col("key"), bits, least=1), "simhash-filter")
    flag = f"{key}_flag"
    flagged = maybe_set(rows, F.col(key), present, bits, flag)
    named = [F.col(f"`{c}`") for c in columns]
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
    best = (
        flagged.where(flag)
        .groupBy(F.col(key).alias("key"))
        .agg(F.min_by(F.struct(*named), order).alias("whole"), F.min(order).alias("order"))
        .join(shared, "key", "left")
        # A key alone in its component is its own root.
        .groupBy("root", F.when(F.col("root").isNull(), F.col("key")).alias("alone"))
        .agg(F.min_by("whole", F.struct("order", "key")).alias("whole"))
        .select("whole.*")
    )
    return flagged.where(~F.col(flag)).select(*named).unionByName(best)


def free_name(docs: DataFrame, start: str) -> str:
    """A column name longer than any of ``docs``, so that it clashes with none."""
    return start + "_" * max([0, *(len(c) for c in docs.columns)])


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: the smallest doc_id."""
    shared = stored(
        members_of(stored(fingerprints(docs), "simhash")).where("n_rows > 1").select(F.col("print").alias("key"), "root"),
        "simhash-shared",
    )

    @F.pandas_udf("bigint")
    def print_of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    name = free_name(docs, "_print")
    return one_a_component(docs.withColumn(name, print_of(F.col("text"))), name, shared, docs.columns)
