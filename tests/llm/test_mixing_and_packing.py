"""Mixing against its targets, packing against exhaustive search."""

import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import ODD, clashing, collected, make_docs, odd  # noqa: F401
from pyspark.sql import functions as F

from clickloom.llm import mixing, packing


def brute_targets(sizes):
    """Targets by repeated resharing; sizes: source -> words."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, target = float(sum(sizes.values())), set(order), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def corpus():
    rows = []
    for i in range(900):
        source = "big" if i % 3 == 0 else [None, "a", "é", "Z", ""][i % 5]
        rows.append((i, " ".join(["w"] * (1 + (i * 37) % 60)), source))
    return rows


def test_targets_and_taken(make_docs):
    rows = corpus()
    got = mixing.mix(make_docs(rows)).collect()
    sizes, taken, source = Counter(), Counter(), {i: s for i, _, s in rows}
    for i, text, s in rows:
        sizes[s] += len(text.split())
    want = brute_targets(sizes)
    assert len(got) == len(rows)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == len(rows[r["doc_id"]][1].split())
        assert r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s], rel=1e-9)
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.01 * want[s]
    again = collected(mixing.mix(make_docs(rows)), "doc_id", "taken", "shards")
    assert again == sorted(((r["doc_id"], r["taken"], r["shards"]) for r in got), key=repr)


def test_limit_is_reshared(make_docs):
    rows = [(i, "w w w w", "a") for i in range(2)] + [(10 + i, "w " * 10, "b") for i in range(40)]
    got = mixing.mix(make_docs(rows)).collect()
    targets = {r["source_size"]: r["target"] for r in got}
    assert targets == {8: 24.0, 400: 384.0}
    assert all(r["taken"] == 12 for r in got if r["doc_id"] < 2)


def test_tree_keeps_quotas(make_docs):
    docs = make_docs(corpus())
    rows = mixing.stored(mixing.sized(docs), "t")
    plan = mixing.plan_of(rows, 3)
    draws = defaultdict(int)
    for p in plan.collect():
        assert len(p["ends"]) == 8 and p["ends"] == sorted(p["ends"])
        for node, (a, b) in enumerate(zip([0, *p["ends"]], p["ends"])):
            draws[node] += b - a
    assert max(draws.values()) - min(draws.values()) <= 3  # halves at each of three levels
    shards = [s for r in mixing.mix(docs, 3).collect() for s in r["shards"]]
    assert set(shards) <= set(range(8)) and len(set(shards)) == 8


def test_identical_rows_are_taken_in_part(make_docs):
    """A third of the rows is one document, and half of its source."""
    rows = [(1, "w w w w w", "a")] * 300 + [(i, "w w w w w", "b") for i in range(2, 602)]
    got = mixing.mix(make_docs(rows)).collect()
    by = Counter()
    for r in got:
        by[r["source_size"]] += r["taken"]
    target = {r["source_size"]: r["target"] for r in got}
    assert all(abs(by[s] - target[s]) <= 5 for s in by)


@pytest.mark.parametrize("salt", range(3))
def test_one_very_long_text_does_not_end_the_mix(make_docs, salt):
    """Short rows behind a text longer than the rest of the target are taken."""
    rows = [(i, "w " * (5 + i % 6), "b") for i in range(salt, 2000 + salt)]
    rows += [(-1 - salt, "w " * 14_000, "b")]
    rows += [(10_000 + i, "w " * 30, "a") for i in range(400)]
    got = mixing.mix(make_docs(rows)).where("source_size > 12000").collect()
    target, taken = got[0]["target"], sum(r["taken"] for r in got)
    assert len(got) == 2001 and target < 0.5 * got[0]["source_size"]
    assert abs(taken - target) <= 0.01 * target


def test_split_and_order_of_rows_do_not_change_the_mix(spark, make_docs):
    """Also where the input's rows are split anew at each read."""
    rows = corpus()[:300] + [(5000, "w " * 9, "a")] * 40
    docs = make_docs(rows)
    once = mixing.mix(docs.coalesce(1))
    again = mixing.mix(docs.orderBy(F.rand(3)).repartition(5))
    want = collected(once, "doc_id", "taken", "shards")
    assert collected(again, "doc_id", "taken", "shards") == want
    unsteady = docs.orderBy(F.rand()).repartition(5)
    texts = Counter(r["doc_id"] for r in mixing.mixed(unsteady.withColumn("x", F.rand())).collect())
    times = Counter()
    for doc_id, _, shards in want:
        times[doc_id] += len(shards)
    assert texts == +times


def test_odd_rows_and_mixed(clashing, make_docs):
    got = mixing.mix(clashing)
    assert got.count() == len(ODD)
    mixed = mixing.mixed(clashing)
    assert mixed.columns == clashing.columns
    wanted = got.agg(F.sum(F.size("shards"))).first()[0]
    assert mixed.count() == wanted
    none = make_docs([(1, "a")]).where("doc_id < 0")
    assert mixing.mix(none).count() == mixing.mixed(none).count() == 0


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


def test_bounds_equal_exhaustive_search():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n, k = int(rng.integers(1, 9)), int(rng.integers(1, 5))
        lengths = np.sort(rng.choice(np.arange(1, 50), n, replace=False))
        counts = rng.integers(1, 9, n)
        bounds = packing.best_bounds(lengths, counts, k)
        best = min(
            padding(lengths, counts, [*chosen, lengths[-1]])
            for r in range(k)
            for chosen in itertools.combinations(lengths[:-1], r)
        )
        assert len(bounds) <= k and padding(lengths, counts, bounds) == best


def test_pack_batches(make_docs):
    rows = [(i, " ".join(["w"] * (1 + i * i % 97))) for i in range(400)] + [(7, "w w w")] * 2500 + ODD
    docs = make_docs(rows)
    got = packing.pack(docs, max_length=64, buckets=4, budget=256).collect()
    pieces = Counter()
    for doc_id, text, *_ in rows:
        n = len([w for w in (text or "").split()]) if text != ODD[8][1] else 4
        for p in range(-(-n // 64)):
            pieces[(doc_id, p, min(64, n - 64 * p))] += 1
    assert Counter((r["doc_id"], r["piece"], r["length"]) for r in got) == pieces
    batches = defaultdict(list)
    for r in got:
        assert r["length"] <= r["padded_length"] and r["padding"] == r["padded_length"] - r["length"]
        batches[(r["bucket"], r["batch"])].append(r)
    for (bucket, batch), members in batches.items():
        room = 256 // members[0]["padded_length"]
        assert sorted(m["slot"] for m in members) == list(range(len(members)))
        assert len(members) <= room
        if (bucket, batch + 1) in batches:
            assert len(members) == room
    histogram = Counter(r["length"] for r in got)
    lengths = np.array(sorted(histogram))
    bounds = packing.best_bounds(lengths, np.array([histogram[n] for n in lengths]), 4)
    assert {r["padded_length"] for r in got} == set(bounds)


def test_pack_empty_and_texts(make_docs, clashing):
    none = make_docs([(1, "a"), (2, None), (3, " ")]).where("doc_id > 1")
    assert packing.pack(none).count() == 0
    assert packing.pack(clashing).count() > 0
    texts = packing.texts_of(make_docs([(1, " a b\tc d  e ")]), 2)
    assert collected(texts, "doc_id", "piece", "text") == [(1, 0, "a b"), (1, 1, "c d"), (1, 2, "e")]
