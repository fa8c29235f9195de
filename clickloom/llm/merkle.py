"""Merkle manifest of a table: slot pivot.

H is the lowercase hex SHA-256 of its inputs, one behind the other. Each row is
a leaf: H of its fields, each ``-`` if null, else its length in UTF-8 bytes,
``:`` and its value. The leaves of a source, in order, are cut into runs of
``fanout``; each run becomes one node, level by level, until one is left, the
subroot. The subroots, in order of their sources, become the root the same way.

Slot pivot: conditional aggregates spread the children of a parent into fanout
columns. Concatenating the columns gives the parent's hash; leaving out a
child's own column gives its siblings. On the way back each parent row hands
its children their path, (left, right) siblings of every level up to the root,
so no row is joined to its parent. ``fold`` rebuilds the root from a leaf and a
path alone.

Positions in a source come from a sort by range and counts of its pieces, never
from a sort of one source in one task: the leaf hash and a row number end the
sort key, so even a third of all rows with one source and one doc_id spread.

Defined results: null sources are one source, first in order; a null doc_id
comes first in its source; rows of equal doc_id are ordered by leaf, so
repeated rows are neighbours and interchangeable; a null text and an empty one
have different leaves; texts of any length are hashed whole; a lone leaf is its
subroot and a lone subroot the root (the proof of a table's only row is empty);
an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import stored

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_EVERY = 5
SMALL = 100_000  # pieces of sources (about 40 bytes each) that may be broadcast
PATH = "array<struct<left: string, right: string>>"


def field(value: Column) -> Column:
    """A value as it enters the leaf."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    """H of the fields of a row."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda acc, step: F.sha2(F.concat(step["left"], acc, step["right"]), 256))


def proof_of(path: Column) -> Column:
    """H of all siblings on the path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _with(rows: DataFrame, more: DataFrame, *keys: str, broadcast: bool = False) -> DataFrame:
    """Rows with the columns of ``more`` for their tree and ``keys``; a null tree is a tree."""
    names = {c: f"{c}_of_more" for c in ("tree", *keys)}
    more = more.withColumnsRenamed(names)
    same = F.col("tree").eqNullSafe(F.col(names["tree"]))
    for c in keys:
        same = same & (F.col(c) == F.col(names[c]))
    return rows.join(F.broadcast(more) if broadcast else more, same).drop(*names.values())


def _numbered(leaves: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Leaves (tree, key, hash, ...) with ``at``, their place in the tree, and ``n``, the tree's leaves.

    Also the largest ``n``.
    """
    spark = leaves.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    leaves = stored(leaves.withColumn("tie", F.monotonically_increasing_id()), f"{label}-leaves")
    order = ["tree", "key", "hash", "tie"]
    # The number that grows along the sorted rows of each partition; its upper
    # bits are the partition.
    ordered = stored(
        leaves.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .drop("tie")
        .withColumn("seq", F.monotonically_increasing_id())
        .withColumn("piece", F.shiftright("seq", 33)),
        f"{label}-ordered",
    )
    sizes = ordered.groupBy("tree", "piece").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("size"))
    # One row a piece, so a tree has at most as many as there are partitions.
    tree = Window.partitionBy("tree")
    before = tree.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "tree",
        "piece",
        (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("size").over(tree).alias("n"),
    )
    starts = stored(starts, f"{label}-starts")
    size = starts.agg(F.count(F.lit(1)).alias("pieces"), F.max("n").alias("most")).first()
    numbered = _with(ordered, starts, "piece", broadcast=size["pieces"] <= SMALL)
    return numbered.withColumn("at", F.col("seq") + F.col("shift")).drop("seq", "piece", "shift"), size["most"] or 0


def _pivot(nodes: DataFrame, fanout: int, kept: list[str]) -> DataFrame:
    """One row a parent: its children (hash and ``kept`` columns) in columns c0, c1, ..."""
    child = f"struct({', '.join(['hash', *kept])})"
    slots = [
        F.expr(f"max(CASE WHEN pmod(at, {fanout}) = {i} THEN {child} END) AS c{i}") for i in range(fanout)
    ]
    return nodes.groupBy("tree", F.expr(f"at DIV {fanout} AS at")).agg(F.first("n").alias("n"), *slots)


def _joined(slots: range) -> str:
    """SQL of the hashes of these slots, one behind the other."""
    return f"concat('', {', '.join(f"coalesce(c{i}.hash, '')" for i in slots)})" if slots else "''"


def _parents(pivot: DataFrame, fanout: int) -> DataFrame:
    """The parents as nodes of the next level."""
    return pivot.selectExpr(
        "tree",
        "at",
        f"(n + {fanout - 1}) DIV {fanout} AS n",
        f"sha2({_joined(range(fanout))}, 256) AS hash",
    )


def _children(pivot: DataFrame, fanout: int, kept: list[str]) -> DataFrame:
    """Children of pivot rows that carry ``top`` and their own ``path``, with theirs."""
    slots = [
        f"IF(c{i} IS NULL, NULL, struct(c{i} AS own, at * {fanout} + {i} AS at, concat(array(struct("
        f"{_joined(range(i))} AS left, {_joined(range(i + 1, fanout))} AS right)), path) AS path))"
        for i in range(fanout)
    ]
    each = pivot.selectExpr("tree", "top", f"explode(array_compact(array({', '.join(slots)}))) AS child")
    return each.selectExpr("tree", "child.at", "child.own.hash", *[f"child.own.{c}" for c in kept], "top", "child.path")


def _climb(
    nodes: DataFrame, most: int, fanout: int, label: str, kept: list[str]
) -> tuple[list[DataFrame], list[DataFrame]]:
    """By level, from the leaves: tops of the trees with one node left, and the pivots of all others.

    ``most`` is the largest number of leaves of a tree.
    """
    tops, pivots, columns = [nodes.where("n = 1").select("tree", "at", "hash", *kept)], [], kept
    while most > 1:
        pivots.append(stored(_pivot(nodes.where("n > 1"), fanout, columns), f"{label}-pivot"))
        nodes = _parents(pivots[-1], fanout)
        tops.append(nodes.where("n = 1").select("tree", "at", "hash"))
        columns, most = [], -(-most // fanout)
    return tops, pivots


def _descend(
    roots: DataFrame, tops: list[DataFrame], pivots: list[DataFrame], fanout: int, kept: list[str]
) -> DataFrame:
    """Leaves with ``top`` and ``path``.

    ``roots`` (tree, top, path) has a row a tree; a tree enters the way down at
    the level where it had one node left.
    """

    def entering(level: DataFrame) -> DataFrame:
        return _with(level, roots)

    nodes = entering(tops[-1])
    for i in range(len(pivots) - 1, -1, -1):
        columns = [] if i else kept
        whole = _with(pivots[i], nodes.select("tree", "at", "top", "path"), "at")
        nodes = _children(whole, fanout, columns).unionByName(entering(tops[i]))
    return nodes


def manifest(
    docs: DataFrame,
    leaf: Column,
    changed: Column | None = None,
    tree: str = "source",
    key: str = "doc_id",
    fanout: int = FANOUT,
) -> DataFrame:
    """``key``, leaf, subroot, root, path and ``changed`` of every row of ``docs``.

    ``changed`` is a second leaf that travels along, e.g. one computed later.
    """
    leaves = docs.select(
        F.col(f"`{tree}`").alias("tree"),
        F.col(f"`{key}`").alias("key"),
        leaf.alias("hash"),
        (F.lit(None).cast("string") if changed is None else changed).alias("changed"),
    )
    kept = ["key", "changed"]
    tops, pivots = _climb(*_numbered(leaves, "merkle"), fanout, "merkle", kept)
    subroots = [level.select(F.lit(0).alias("tree"), F.col("tree").alias("key"), "hash") for level in tops]
    above, upper = _climb(
        *_numbered(reduce(DataFrame.unionByName, subroots), "merkle-top"), fanout, "merkle-top", ["key"]
    )
    top = above[-1].select("tree", F.col("hash").alias("top"), F.array().cast(PATH).alias("path"))
    sources = _descend(top, above, upper, fanout, ["key"])
    roots = stored(
        sources.select(
            F.col("key").alias("tree"),
            F.struct(F.col("hash").alias("subroot"), F.col("top").alias("root")).alias("top"),
            "path",
        ),
        "merkle-roots",
    )
    rows = _descend(roots, tops, pivots, fanout, kept)
    return rows.select(
        F.col("key").alias(key),
        F.col("hash").alias("leaf"),
        "top.subroot",
        "top.root",
        "path",
        "changed",
    )


def audit(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The manifest of ``docs``, held against a copy in which every fifth row was tampered with.

    doc_id, leaf, subroot, root, proof_sha256, folded_root (from the leaf as
    found, and the path) and verified (folded_root is the root).
    """
    values = [F.col(c) for c in FIELDS]
    tampered = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(TAMPERED_EVERY)) == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.when(tampered, leaf_of(*values[:-1], lowered))
    rows = manifest(docs, leaf_of(*values), found, fanout=fanout)
    rows = rows.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_of(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
