"""Near duplicates by shingle similarity against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import ODD, clashing, collected, make_docs, odd  # noqa: F401
from pyspark.sql import functions as F

from clickloom.llm import near_texts


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def word_shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return {" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def similar(a, b):
    both = len(a & b)
    return a == b or both >= 0.8 * (len(a) + len(b) - both)


def brute_kept(rows):
    """doc_ids of the documents that stay, by comparing all pairs; nulls last."""
    sets = [word_shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc_id, *_) in enumerate(rows):
        groups.setdefault(find(i), []).append((doc_id is None, doc_id or 0))
    return sorted(None if none else doc_id for none, doc_id in map(min, groups.values()))


def planted(n, copies, seed=4, length=(60, 240)):
    """Texts of their own and, of the first ones, copies of similarity 0.80 to 0.95 and below 0.7."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [[rng.choice(vocabulary) for _ in range(rng.randint(*length))] for _ in range(n)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    near, far = [], []
    for i in range(copies):
        original = texts[i % (n // 2)]
        for wanted, found in ((rng.uniform(0.80, 0.95), near), (0.55, far)):
            text = list(original)
            own = word_shingles(" ".join(original))
            while True:
                changed = list(text)
                changed[rng.randrange(len(text))] = rng.choice(vocabulary)
                other = word_shingles(" ".join(changed))
                if len(own & other) < wanted * len(own | other):
                    break
                text = changed
            doc_id = 100_000 + len(near) * 2 + (found is far)
            rows.append((doc_id, " ".join(text)))
            found.append((i % (n // 2), doc_id))
    return rows, near, far


def test_wide_print_equals_its_definition():
    text = "A b c d a b c"
    hashes = [int(h) for h in near_texts.shingles(text, 2)]
    assert len(hashes) == 4  # a b, b c, c d, d a
    mask = 2**64 - 1
    for i, got in enumerate(near_texts.wide_print(text, 3)):
        own = []
        for h in hashes:
            h ^= (i + 1) * 0x9E3779B97F4A7C15 & mask
            h = (h ^ h >> 33) * 0xFF51AFD7ED558CCD & mask
            h = (h ^ h >> 33) * 0xC4CEB9FE1A85EC53 & mask
            own.append(h ^ h >> 33)
        assert int(got) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > len(own))
    wide = near_texts.wide_print(text, 3)
    values = near_texts.block_values(wide, 6, 24)
    whole = sum(int(w) << 64 * i for i, w in enumerate(wide))
    assert values.tolist() == [whole >> 24 * i & 0xFFFFFF for i in range(6)]
    assert not near_texts.wide_print(" \n", 2).any() and len(near_texts.wide_print("word " * 30_000, 1)) == 1


def test_planted_copies_are_found(make_docs):
    rows, near, far = planted(120, 60)
    kept = [r["doc_id"] for r in near_texts.deduplicate(make_docs(rows)).collect()]
    want = brute_kept(rows)
    assert set(want) <= set(kept)  # nothing goes that is not similar
    caught = [d for _, d in near if d not in kept]
    assert len(caught) >= 0.95 * len(near)
    assert all(d in kept for _, d in far if d in want)


@pytest.mark.parametrize("at_once", [8, 128])
def test_large_groups_lose_no_link(make_docs, at_once, monkeypatch):
    """Chains of copies of copies and unrelated texts, all in one block."""
    monkeypatch.setattr(near_texts, "block_values", lambda wide, blocks, bits: np.zeros(blocks, np.int64))
    rng = random.Random(7)
    rows = []
    for chain in range(4):
        text = [f"c{chain}w{rng.randrange(400)}" for _ in range(80)]
        for k in range(8):
            rows.append((100 * chain + k, " ".join(text)))
            text = list(text)
            text[rng.randrange(len(text))] = f"x{k}"
    docs = make_docs(rows)
    roots = near_texts.links(docs, 0.8, 2, 24, at_once)
    found = {}
    for key, root in collected(roots, "key", "root"):
        found.setdefault(root, set()).add(key)
    kept = brute_kept(rows)
    assert len(found) == len(kept) < 10 and sum(map(len, found.values())) == len(rows)


def test_odd_rows(odd, clashing):
    got = near_texts.deduplicate(clashing)
    assert got.columns == clashing.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=repr) == sorted(brute_kept(ODD), key=repr)
    assert near_texts.deduplicate(odd.where("doc_id < 0")).count() == 0


def test_maps_never_rule_out_what_is_common(spark):
    """The bound from two maps is at least what the texts have in common, for short and long texts."""
    rng = np.random.default_rng(3)
    rows, common = [], []
    for n in (0, 1, 7, 300, 5000, 40000):
        pool = rng.integers(0, 2**64, n + n // 4, dtype=np.uint64)
        x, y = np.unique(pool[:n]), np.unique(pool[n // 4 :])
        rows.append((n, near_texts.shingle_map(x).tolist(), len(x), near_texts.shingle_map(y).tolist(), len(y)))
        common.append(len(np.intersect1d(x, y)))
    maps = spark.createDataFrame(rows, "n long, mx array<bigint>, nx int, my array<bigint>, ny int")
    most = near_texts.most_in_common(F.col("mx"), F.col("nx"), F.col("my"), F.col("ny"))
    bounds = [r.most for r in maps.select("n", most.alias("most")).orderBy("n").collect()]
    assert all(b >= c for b, c in zip(bounds, common, strict=True))
    assert bounds[3] <= 1.2 * common[3]  # and tells something about texts of usual length


def test_workers_hash_few_texts_at_a_time():
    """One large batch leaves the workers in small parts, every row once and in order."""
    n = 3 * near_texts.PIECE + 5
    texts = [f"a{i} b c d e f{i}" for i in range(n)]
    batch = pa.RecordBatch.from_pydict({"key": [str(i) for i in range(n)], "hash": list(range(n)), "id": list(range(n)), "text": texts})
    for work, name in ((near_texts._prints(4, 24), "key"), (near_texts._shingled, "id")):
        parts = list(work(iter([batch])))
        assert max(p.num_rows for p in parts) <= near_texts.PIECE
        assert [v for p in parts for v in p.column(name).to_pylist()] == batch.column(name).to_pylist()


@pytest.mark.parametrize("few", [0, near_texts.FEW])
def test_texts_without_a_pair_never_move(spark, few, monkeypatch):
    """Both sides of a few pairs are found among many texts; only about their rows enter a shuffle."""
    monkeypatch.setattr(near_texts, "FEW", few)
    texts = spark.range(20_000).select("id", F.col("id").cast("int").alias("n"))
    pairs = spark.createDataFrame([(i, i + 100) for i in range(0, 1000, 10)], "a long, b long")
    wanted = {i for a in range(0, 1000, 10) for i in (a, a + 100)}
    found = near_texts._only(texts, "id", near_texts._ids_of(pairs))
    got = {r.id for r in found.collect()}
    assert wanted <= got and len(got) < 2 * len(wanted)
    assert "hashpartitioning(id" not in found._jdf.queryExecution().sparkPlan().toString()
    sides = near_texts._sides(pairs, near_texts._ids_of(pairs), texts, "n").collect()
    assert sorted((r.a, r.b, r.n_a, r.n_b) for r in sides) == [(i, i + 100, i, i + 100) for i in range(0, 1000, 10)]


def test_shingles_need_no_worker(spark):
    """The native hashes are those of the workers, for odd, short, long and repeating texts."""
    texts = [None, "", " \n", "One", "a b", "A  b\tc d", "a b c d e", " lead a B c d e f g\r\n", "\x1cx \x85 y z Ä ß 𝄞 b c"]
    texts += ["İ I ı K c d e f", "a\x00b c d e f g", "x " * 3000, " ".join(f"w{i % 70}" for i in range(2000))]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.shingles for r in rows.select("id", near_texts.shingle_hashes(F.col("text")).alias("shingles")).collect()}
    made = {r.id: r.shingles for r in rows.mapInArrow(near_texts._shingled, "id bigint, shingles array<bigint>").collect()}
    for i, text in enumerate(texts):
        assert sorted(got[i]) == sorted(made[i]) == sorted(near_texts.shingles(text, 5).view(np.int64).tolist())


def test_only_the_prints_need_workers(make_docs, monkeypatch):
    """Rounds over pairs run without Python workers, whose memory would add to that of the executor."""
    rows, near, _ = planted(60, 30)
    docs, calls = make_docs(rows), []
    kind = type(docs)
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **b: calls.append(a[1]) or plain(self, *a, **b))
    kept = {r["doc_id"] for r in near_texts.deduplicate(docs).collect()}
    assert any(d not in kept for _, d in near)
    assert len(calls) == 1 and "blocks" in calls[0]
