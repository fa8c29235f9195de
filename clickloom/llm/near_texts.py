"""Near-duplicate texts by similarity of their word shingles, found by SimHash.

Two texts are near duplicates if the sets of their five-word shingles have a
Jaccard similarity of ``similarity`` or more. A 64-bit fingerprint of such
shingles differs in about ten bits at 0.8, too many to find by blocks of a few
bits. So fingerprints are wide (``blocks`` x ``block_bits`` bits) and made of
two-word shingles, of which an edit changes fewer. Close pairs share a block
(with 40 blocks of 24 bits: nearly all at 8 % differing bits, the median of pairs
above 0.8 in the test corpora, and nine in ten at 11 %, their ninetieth
percentile), are joined on blocks, held against a Hamming distance over the first
128 bits, and then verified exactly by their five-word shingles. The shingles
travel only for pairs that a small map of them cannot rule out: a bit for each
of 4,096 hash ranges bounds what two texts have in common from above, so a pair
it rules out is surely below the similarity.

Texts that share a block make no pairs among all of them. Each round takes some
texts of a block's group and holds them against the others; texts found to be
linked, through whatever other texts, need no further test, so a group of near
copies is done after its first star. A group is done when all its texts are in
one component or all pairs across components are tested: no linked pair of a
group is lost, no round makes more than ``AT_ONCE`` pairs a text, and no pair is
verified twice, however many blocks its texts share.

Defined results: letters A-Z count as a-z and white space as one space; texts
equal after that are one text; a text of fewer words than a shingle is one
shingle, and one without words (null, empty, blank) is linked to its like only;
texts of any length are read whole; of each component the smallest doc_id stays,
a null one last, of rows equal in doc_id and text one; repeated rows are one
text; an empty table gives an empty result; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import SPACE_CHARS, SPACES, ship, stored, words_of
from clickloom.llm.exact_dedup import filter_bits, maybe_set, set_positions
from clickloom.llm.simhash import components, free_name, one_a_component

SIMILARITY = 0.8
SHINGLE = 5  # words, of the similarity
PRINT_SHINGLE = 2  # words, of the fingerprint
BLOCKS, BLOCK_BITS = 40, 24
LEAD = 2  # longs of the fingerprint that travel with each key
LEADS = [f"lead_{i}" for i in range(LEAD)]
LEAD_DISTANCE = 32  # of 128 bits; unrelated texts differ in about 60
AT_ONCE = 128
BITS_AT_ONCE = 4096
MAP_LONGS = 64  # longs of a text's map of shingles
FEW = 20_000  # keys that are broadcast as they are; a filter is made of more
PIECE = 256  # texts that a worker hashes together
SEED = 42

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_key(text: Column) -> Column:
    """What texts are equal by: a digest of the words, A-Z lower-cased."""
    return F.md5(F.trim(F.regexp_replace(_lowered(text), SPACES, " "), F.lit(SPACE_CHARS)))


def shingle_hashes(text: Column) -> Column:
    """The hashes of ``shingles`` at ``SHINGLE`` words as an array, made without a Python worker; Spark's seed is ``SEED``."""
    one = lambda words: lambda i: F.xxhash64(F.array_join(F.slice(words, i, SHINGLE), " "))
    starts = lambda words: F.sequence(F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1)))
    # As the argument of a function the words are split once a text, not once a shingle.
    hashes = F.transform(F.array(words_of(_lowered(text))), lambda w: F.when(F.size(w) > 0, F.transform(starts(w), one(w))))
    return F.array_distinct(F.coalesce(hashes[0], F.array().cast("array<bigint>")))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct XXH64 of a text's shingles; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    width = min(width, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - width + 1
    pairs = zip(starts[:n].tolist(), ends[width - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, n))


def wide_print(text: str | None, longs: int) -> np.ndarray:
    """A SimHash of ``longs`` x 64 bits; each long has hashes of its own, derived from one."""
    hashes, out = shingles(text, PRINT_SHINGLE), np.zeros(longs, np.uint64)
    for i in range(longs if len(hashes) else 0):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), BITS_AT_ONCE):
            h = hashes[at : at + BITS_AT_ONCE] ^ np.uint64((i + 1) * 0x9E3779B97F4A7C15 % 2**64)
            h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
            h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
            h ^= h >> np.uint64(33)
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
    return out


def block_values(wide: np.ndarray, blocks: int, bits: int) -> np.ndarray:
    """The blocks of a wide fingerprint as numbers."""
    each = np.unpackbits(wide.view(np.uint8), bitorder="little")[: blocks * bits].reshape(blocks, bits)
    return each.astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))


def shingle_map(hashes: np.ndarray) -> np.ndarray:
    """Which of ``MAP_LONGS`` x 64 equal ranges the hashes of shingles fall into, as bits."""
    bits = np.zeros(MAP_LONGS * 64, np.uint8)
    bits[hashes // np.uint64(2**64 // bits.size)] = 1
    return np.packbits(bits, bitorder="little").view("<i8")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in small parts: a worker holds the hashes of ``PIECE`` texts at a time, not of a whole batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            yield batch.slice(at, PIECE)


def _prints(blocks: int, bits: int):
    longs = max(LEAD, -(-blocks * bits // 64))
    parts = np.arange(blocks, dtype=np.int64) << bits

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            texts = [text.as_py() for text in batch.column("text")]
            wides = [wide_print(text, longs) for text in texts]
            rows = [shingles(text, SHINGLE) for text in texts]
            lead = np.stack([w[:LEAD].view(np.int64) for w in wides])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("hash"),
                    pa.array([len(r) for r in rows], pa.int32()),
                    *[pa.array(lead[:, i]) for i in range(LEAD)],
                    pa.array([parts + block_values(w, blocks, bits) for w in wides], pa.list_(pa.int64())),
                    pa.array([shingle_map(r) for r in rows], pa.list_(pa.int64())),
                ],
                ["key", "hash", "n", *LEADS, "blocks", "map"],
            )

    return work


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``shingle_hashes`` gives, made by workers; the tests hold one against the other."""
    for batch in _pieces(batches):
        rows = [shingles(text.as_py(), SHINGLE).view(np.int64) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.list_(pa.int64()))], ["id", "shingles"])


def most_in_common(map_a: Column, n_a: Column, map_b: Column, n_b: Column) -> Column:
    """No two texts with these maps and numbers of shingles have more shingles in common.

    Each range set in both holds one common shingle, and one more for each
    shingle of a text beyond the first of its range.
    """
    ones = lambda bits: F.aggregate(bits, F.lit(0), lambda n, x: n + F.bit_count(x).cast("int"))
    both = ones(F.zip_with(map_a, map_b, lambda x, y: x.bitwiseAND(y)))
    return both + F.least(n_a - ones(map_a), n_b - ones(map_b))


def _together(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _ids_of(pairs: DataFrame) -> DataFrame:
    """The texts of some pairs."""
    return stored(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "near-wanted")


def _among(rows: DataFrame, key: str, chosen: DataFrame) -> DataFrame:
    """``rows`` with flag ``among``: true where ``key`` is one of ``chosen``, and for few others.

    Told by a filter of bounded size, so that no row has to move to be told apart.
    """
    bits = filter_bits(chosen.count())
    present = stored(set_positions(chosen, F.col(key), bits, least=1), "near-filter")
    return maybe_set(rows, F.col(key), present, bits, "among")


def _only(rows: DataFrame, key: str, chosen: DataFrame) -> DataFrame:
    """All rows whose ``key`` is one of ``chosen``, and few others; none moves."""
    if chosen.count() <= FEW:
        return rows.join(F.broadcast(chosen.select(key)), key, "left_semi")
    return _among(rows, key, chosen).where("among").drop("among")


def _with_shingles(made: list[DataFrame], wanted: DataFrame, texts: DataFrame, docs: DataFrame) -> list[DataFrame]:
    """Shingles of all wanted texts: those of former rounds and the new ones.

    The texts are found by a fast hash first; only what that leaves is held against the keys.
    No Python worker takes part, so those of the prints end while the rounds go on.
    """
    if made:
        known = _together([part.select("id") for part in made])
        wanted = stored(wanted.join(known, "id", "left_anti"), "near-wanted")
    if wanted.isEmpty():
        return made
    named = _only(texts.select("id", "key", "hash"), "id", wanted).join(wanted, "id", "left_semi")
    named = stored(named.select("id", "key", "hash"), "near-named")
    found = _only(docs.select("text", F.xxhash64("text").alias("hash")), "hash", named)
    found = found.select(text_key(F.col("text")).alias("key"), "text").groupBy("key").agg(F.first("text").alias("text"))
    new = found.join(named, "key").select("id", shingle_hashes(F.col("text")).alias("shingles"))
    return [*made, stored(new, "near-shingles")]


def _sides(pairs: DataFrame, ids: DataFrame, of_texts: DataFrame, *columns: str) -> DataFrame:
    """The pairs with ``columns`` of both texts; only the rows of ``ids``, the texts that occur, are moved."""
    rows = _only(of_texts.select("id", *columns), "id", ids)
    for name in ("b", "a"):
        side = rows.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])
        pairs = pairs.join(side, name)
    return pairs


def _likely(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Of the pairs (a, b), those that the maps of their texts cannot rule out."""
    most = most_in_common(F.col("map_a"), F.col("n_a"), F.col("map_b"), F.col("n_b"))
    return (
        _sides(pairs, _ids_of(pairs), texts, "n", "map")
        .where(most >= F.lit(similarity) * (F.col("n_a") + F.col("n_b") - most))
        .select("a", "b")
    )


def _verified(pairs: DataFrame, ids: DataFrame, made: DataFrame, similarity: float) -> DataFrame:
    """Of the pairs (a, b), those whose texts are similar enough."""
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - both
    return _sides(pairs, ids, made, "shingles").where(both >= F.lit(similarity) * union).select("a", "b")


def _roots(edges: DataFrame) -> DataFrame:
    """id and root of all texts on an edge, the roots themselves among them."""
    found = components(edges.distinct()).select(F.col("node").alias("id"), "root")
    return stored(found.unionByName(found.select(F.col("root").alias("id"), "root").distinct()), "near-roots")


def _texts(docs: DataFrame, blocks: int, bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The prints of all rows, each with a number of its own; of those one row a text; keys of several rows."""
    ship(docs.sparkSession)
    fields = ["key string, hash bigint, n int", *[f"{c} bigint" for c in LEADS], "blocks array<bigint>, map array<bigint>"]
    keyed = docs.select(text_key(F.col("text")).alias("key"), F.xxhash64("text").alias("hash"), "text")
    prints = keyed.mapInArrow(_prints(blocks, bits), ", ".join(fields))
    rows = stored(prints.withColumn("id", F.monotonically_increasing_id()), "near-prints")
    firsts = rows.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    repeated = stored(firsts.where("n > 1").select("key", "id"), "near-repeated")
    if repeated.isEmpty():
        return rows, rows, repeated
    # Only rows of repeated texts are held against the first of their text.
    flagged = _among(rows, "key", repeated)
    copies = flagged.where("among")
    firsts = stored(copies.groupBy("key").agg(F.min("id").alias("id")).select("id"), "near-firsts")
    once = flagged.where(~F.col("among")).unionByName(copies.join(firsts, "id", "left_semi")).drop("among")
    return rows, once, repeated


def links(docs: DataFrame, similarity: float, blocks: int, bits: int, at_once: int = AT_ONCE) -> DataFrame:
    """key and root of all texts that are linked to another one."""
    return _links(docs, *_texts(docs, blocks, bits)[:2], similarity, at_once)


def _links(docs: DataFrame, texts: DataFrame, once: DataFrame, similarity: float, at_once: int) -> DataFrame:
    said = ["id", "n", *LEADS, "block"]  # what a text takes along to each of its groups
    keys = once.select("id", "n", *LEADS, F.explode("blocks").alias("block"))
    shared = stored(
        keys.groupBy("block").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("block"), "near-groups"
    )
    # What is still to be tested: texts by group, one row a text and group.
    open_rows = stored(_only(keys, "block", shared).join(shared, "block", "left_semi").select(*said), "near-open")
    roots: DataFrame | None = None
    tested: list[DataFrame] = []  # pairs of former rounds: texts that share several blocks meet in several groups
    made: list[DataFrame] = []  # shingles of the texts of those pairs
    take = 1  # a star a group, then two, four, ...: few stars connect a group of near copies
    while not open_rows.isEmpty():
        named = open_rows.withColumn("root", F.col("id"))
        if roots is not None:
            named = open_rows.join(roots, "id", "left").select(*said, F.coalesce("root", "id").alias("root"))
            named = stored(named, "near-rooted")
        sizes = named.groupBy("block", "root").agg(F.count(F.lit(1)).alias("size"))
        # The largest component of the group; done if it is the only one.
        most = sizes.groupBy("block").agg(
            F.max(F.struct("size", "root")).alias("most"), F.count(F.lit(1)).alias("parts")
        )
        most = most.where("parts > 1").select("block", F.col("most.root").alias("main"))
        active = stored(
            named.join(most, "block").select(*said, "root", (F.col("root") != F.col("main")).alias("other")),
            "near-active",
        )
        order = Window.partitionBy("block").orderBy("id")
        taken = stored(
            active.where("other").withColumn("place", F.row_number().over(order)).where(F.col("place") <= take).drop("place"),
            "near-taken",
        )
        a, b = (
            side.select("block", *[F.col(c).alias(f"{c}_{n}") for c in ("id", "n", "root", *LEADS)])
            for side, n in ((taken, "x"), (active, "y"))
        )
        apart = sum((F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y"))) for c in LEADS), start=F.lit(0))
        # Texts have no more in common than the shorter has shingles, and no fewer in all than the longer.
        long_enough = F.least("n_x", "n_y") >= F.lit(similarity) * F.greatest("n_x", "n_y")
        pairs = (
            a.join(b, "block")
            .where((F.col("root_x") != F.col("root_y")) & long_enough & (apart <= LEAD_DISTANCE))
            .select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b"))
            .distinct()
        )
        if tested:
            pairs = pairs.join(_together(tested), ["a", "b"], "left_anti")
        pairs = stored(pairs, "near-pairs")
        if not pairs.isEmpty():
            tested.append(pairs)
            likely = stored(_likely(pairs, texts, similarity), "near-likely")
            if not likely.isEmpty():
                ids = _ids_of(likely)
                made = _with_shingles(made, ids, texts, docs)
                found = stored(_verified(likely, ids, _together(made), similarity), "near-edges")
                if not found.isEmpty():
                    if roots is not None:
                        found = found.unionByName(roots.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
                    roots = _roots(found)
        open_rows = stored(active.join(taken.select("id", "block"), ["id", "block"], "left_anti").select(*said), "near-open")
        take = min(2 * take, at_once)
    if roots is None:
        return docs.sparkSession.createDataFrame([], "key string, root bigint")
    return stored(_only(texts.select("id", "key"), "id", roots).join(roots, "id").select("key", "root"), "near-linked")


def deduplicate(
    docs: DataFrame, similarity: float = SIMILARITY, blocks: int = BLOCKS, block_bits: int = BLOCK_BITS
) -> DataFrame:
    """One document of each component of near duplicates, with all its columns: the smallest doc_id."""
    texts, once, repeated = _texts(docs, blocks, block_bits)
    roots = _links(docs, texts, once, similarity, AT_ONCE)
    name = free_name(docs, "_key")
    rows = docs.withColumn(name, text_key(F.col("text")))
    # Equal texts are one key; a key with several rows is a component as well.
    root = F.coalesce(F.col("root").cast("string"), "key").alias("root")
    shared = stored(roots.join(repeated.select("key"), "key", "full").select("key", root), "near-shared")
    return one_a_component(rows, name, shared, docs.columns)
