"""The Merkle manifest against a plain recomputation."""

import hashlib
import random
import zlib

import pytest
from llm_cases import DOCUMENTS, ODD, clashing, collected, make_docs, odd  # noqa: F401
from pyspark.sql import functions as F

from clickloom.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return h("".join(map(field, row)))


def climb(hashes, fanout):
    """Root, and of every leaf the list of (left, right) siblings."""
    paths, owners = [[] for _ in hashes], [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        nodes, above = [], []
        for at in range(0, len(hashes), fanout):
            run = hashes[at : at + fanout]
            for i in range(len(run)):
                for owner in owners[at + i]:
                    paths[owner].append(("".join(run[:i]), "".join(run[i + 1 :])))
            nodes.append(h("".join(run)))
            above.append(sum(owners[at : at + fanout], []))
        hashes, owners = nodes, above
    return hashes[0], paths


def brute(rows, fanout=16):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        own = sorted(by_source[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, *climb([leaf(r) for r in own], fanout)))
    if not trees:
        return []
    root, tops = climb([subroot for _, subroot, _ in trees], fanout)
    out = []
    for (own, subroot, paths), top in zip(trees, tops):
        for row, path in zip(own, paths):
            path = path + top
            found = leaf(row)
            if zlib.crc32(str(row[0] if row[0] is not None else "").encode()) % 5 == 0 and row[4] is not None:
                found = leaf((*row[:4], row[4].translate(LOWER)))
            for left, right in path:
                found = h(left + found + right)
            proof = h("".join(left + right for left, right in path))
            out.append((row[0], leaf(row), subroot, root, proof, found, found == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("fanout", [2, 16])
def test_equals_brute_force(spark, fanout):
    rng = random.Random(3)
    sizes = {"a": 1, "b": 16, "c": 17, "Ä": 300, None: 33, "": 2} | {f"s{i}": 1 + i % 3 for i in range(30)}
    rows = [
        (i, s, rng.choice(["en", None]), rng.choice([5, None]), rng.choice([None, "", "Text É", f"Word {i}"]))
        for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))
    ]
    got = merkle.audit(spark.createDataFrame(rows, DOCUMENTS_ORDER).repartition(5), fanout)
    assert collected(got, *COLUMNS) == brute(rows, fanout)


DOCUMENTS_ORDER = "doc_id long, source string, lang string, n_chars long, text string"


def test_odd_rows_and_clashing_columns(odd, clashing):
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in odd.collect()]
    assert len(rows) == len(ODD)
    named = clashing
    for extra in ("tree", "hash", "at", "n", "c0", "path", "top", "changed", "leaf", "seq", "piece", "tie"):
        named = named.withColumn(extra, F.lit("x"))
    assert collected(merkle.audit(odd), *COLUMNS) == collected(merkle.audit(named), *COLUMNS) == brute(rows)


def test_small_tables(spark):
    one = spark.createDataFrame([(7, None, None, None, None)], DOCUMENTS_ORDER)
    (row,) = merkle.audit(one).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"]
    assert row["proof_sha256"] == h("") and row["verified"]
    assert merkle.audit(one.where("doc_id < 0")).count() == 0


def test_one_key_spreads(spark):
    """A third of all rows equal in every column."""
    rows = [(1, "a", "en", 3, "Same")] * 400 + [(i, "a", "en", 3, "Other") for i in range(2, 800)]
    got = merkle.audit(spark.createDataFrame(rows, DOCUMENTS_ORDER).repartition(4))
    assert collected(got, *COLUMNS) == brute(rows)


def test_a_proof_is_bound_to_its_leaf(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, DOCUMENTS_ORDER)
    values = [F.col(c) for c in merkle.FIELDS]
    for changed in range(5):
        other = [F.lit("other").cast(docs.schema[c].dataType) if c == "text" else F.col(c) for c in merkle.FIELDS]
        if changed < 4:
            other = values[:changed] + [F.lit(None).cast(docs.schema[merkle.FIELDS[changed]].dataType)] + values[changed + 1 :]
        got = merkle.manifest(docs, merkle.leaf_of(*values), merkle.leaf_of(*other))
        assert got.where(merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).count() == 100
        assert got.where(merkle.fold(F.col("changed"), F.col("path")) == F.col("root")).count() == 0
