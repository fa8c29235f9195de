"""Registered queries against their SQL; the pipeline stage by stage."""

import os
import sys
from collections import Counter

import duckdb
import pytest
from llm_cases import DOCUMENTS, ODD
from test_dedup_and_simhash import brute_components, brute_exact, norm
from test_mixing_and_packing import brute_targets
from test_near_texts import brute_kept, planted

import corpus_pipeline
from clickloom.llm import queries as registry
from clickloom.llm import packing, quality_classifier
from clickloom.llm.common import stored, table

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from check_queries import compare, tables  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert compare(got, tables(SF_DIR).sql(ORACLE[name]).df()) == "ok"


def documents():
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SF_DIR}/documents.parquet'").fetchall()


def test_op1_against_brute_force(spark):
    sizes, source, total = Counter(), {}, {}
    for doc_id, text, s in documents():
        total[doc_id] = len((text or "").encode().split())
        source[doc_id] = s
        sizes[s] += total[doc_id]
    want, taken = brute_targets(sizes), Counter()
    for r in QUERIES["op1_mixing"](spark, SF_DIR).collect():
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (total[r["doc_id"]], sizes[s])
        assert r["target"] == pytest.approx(want[s]) and r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.05 * want[s] + 20 for s in want)


def test_op8_against_brute_force(spark):
    got = QUERIES["op8_simhash"](spark, SF_DIR).collect()
    found = sorted((tuple(r) for r in got), key=repr)
    assert found == brute_components([(d, t) for d, t, _ in documents()])


def test_op7_against_the_library(spark):
    from tokenizers import Tokenizer

    from clickloom.llm.token_counts import default_vocabulary

    library = Tokenizer.from_file(default_vocabulary())
    want = {d: len(library.encode(t or "", add_special_tokens=False).ids) for d, t, _ in documents()}
    got = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op7_token_counts"](spark, SF_DIR).collect()}
    assert got == want


def test_op6_packs_every_word(spark):
    rows = QUERIES["op6_packing"](spark, SF_DIR).collect()
    packed = Counter()
    for r in rows:
        packed[r["doc_id"]] += r["length"]
    assert packed == Counter({d: n for d, t, _ in documents() if (n := len((t or "").encode().split()))})


def test_pipeline_stage_by_stage(spark):
    docs, outputs = table(spark, SF_DIR, "documents"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), f"test-{name}")
        outputs.append(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    accepted, exact, near, mix, packed = outputs
    # the classifier's decisions take effect
    verdicts = quality_classifier.classify(
        table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    ).where("predicted = 1")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    assert ids(accepted) == ids(verdicts)
    rows = [(r["doc_id"], r["text"]) for r in accepted.collect()]
    assert ids(exact) == sorted({keep for _, keep, _, _ in brute_exact(rows)})
    rows = [(d, t) for d, t in rows if d in set(ids(exact))]
    assert len({norm(t) for _, t in rows}) == len(rows)
    assert ids(near) == brute_kept(rows)
    source = {r["doc_id"]: (r["source"], r["text"]) for r in near.collect()}
    sizes, taken, times = Counter(), Counter(), Counter()
    for s, text in source.values():
        sizes[s] += len((text or "").split())
    for r in mix.collect():
        assert (r["source"], r["text"]) == source[r["doc_id"]]
        times[r["doc_id"]] += 1
        taken[r["source"]] += len((r["text"] or "").split())
    assert max(times.values()) <= 3
    want = brute_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 0.25 * want[s] + 20 for s in want)
    words = Counter()
    for r in packed.collect():
        words[r["doc_id"]] += r["length"]
    assert words == Counter(
        {d: n * size for d, n in times.items() if (size := len((source[d][1] or "").encode().split()))}
    )


def test_run_is_the_stages(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == packing.pack(table(spark, SF_DIR, "documents")).columns and got.count() > 0


def test_pipeline_on_odd_rows_and_planted_copies(spark):
    """Odd rows, clashing columns and near copies through all stages; then no rows at all."""
    copies, near, _ = planted(60, 30, seed=9)
    rows = [(1_000_000 + i if i is not None else None, t) for i, t, *_ in ODD] + copies
    docs = spark.createDataFrame([(i, t, None, f"s{(i or 0) % 3}", None) for i, t in rows], DOCUMENTS).repartition(3)
    for extra in ("key", "root", "whole", "print", "size", "row", "score", "predicted", "sha"):
        docs = docs.withColumn(extra, docs["lang"])
    outputs = []
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stored(stage(spark, docs, SF_DIR), f"odd-{name}")
        outputs.append(docs)
    exact, distinct, mixed, _ = outputs
    assert "whole" in mixed.columns
    kept = {r["doc_id"] for r in distinct.collect()}
    want = set(brute_kept([(r["doc_id"], r["text"]) for r in exact.collect()]))
    assert want <= kept and len(kept - want) <= 0.05 * len(near)
    none = table(spark, SF_DIR, "documents").where("false")
    for name, stage in corpus_pipeline.STAGES:
        none = stored(stage(spark, none, SF_DIR), f"none-{name}")
        assert none.count() == 0
