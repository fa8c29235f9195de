"""Quality rules, token counts, classifiers and URL filters."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import ODD, clashing, collected, make_docs, odd  # noqa: F401
from pyspark.sql import functions as F

from clickloom.llm import quality_classifier, quality_rules, token_counts, toxicity, url_filters


# ---------------------------------------------------------------- quality rules
def brute_repeats(words):
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(8)})


def test_counts_equal_brute_force():
    rng = random.Random(1)
    texts = [t for _, t, *_ in ODD] + [
        "".join(rng.choice(["a ", "b ", "c\n", "#", "! ", "é\t", "A"]) for _ in range(rng.randint(0, 120)))
        for _ in range(400)
    ]
    for text in texts:
        t, raw = quality_rules.Text(text), text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", raw)
        lines = [x for x in raw.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert t.n_words == len(words)
        assert t.word_chars == sum(map(len, words))
        assert t.n_symbols == len(re.findall(r"[#*$%&|<>]", raw))
        assert t.n_dup_lines == sum(x in lines[:i] for i, x in enumerate(lines))
        assert t.n_repeat_words == (brute_repeats(words) if len(words) < 1000 else len(words))
        assert t.n_capitals == len(re.findall("[A-Z]", raw))


def test_order_does_not_change_verdict(make_docs, clashing):
    long = " ".join(f"word{i}" for i in range(30))
    rows = [(1, long), (2, "x"), (3, "| " * 40), (4, long.upper()), (5, "w " * 40), (6, long + "!!!!" * 3)]
    rules = list(quality_rules.RULES)
    for _, text in rows:
        verdicts = {quality_rules.rejected_by(quality_rules.Text(text), o) is None for o in (rules, rules[::-1])}
        assert len(verdicts) == 1
    got = quality_rules.judge(make_docs(rows))
    assert [r["doc_id"] for r in got.where("kept").collect()] == [1]
    order = quality_rules.order_rules(make_docs(rows))
    assert sorted(order) == sorted(rules)
    kept = quality_rules.keep(clashing)
    assert kept.columns == clashing.columns and kept.count() == 0
    assert quality_rules.judge(clashing).count() == len(ODD)
    assert quality_rules.judge(make_docs(rows).where("doc_id < 0")).count() == 0


# ----------------------------------------------------------------- token counts
def test_counts_equal_the_library(make_docs, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_counts.default_vocabulary())
    rng = random.Random(2)
    texts = ["", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "don't  we've\n\n\tit'll", "x" * 5000]
    texts += ["".join(rng.choice("ab cd\n\t'sé日1 2.,!\x1c\U0001f600") for _ in range(60)) for _ in range(300)]
    got = token_counts.count_tokens(make_docs(list(enumerate(texts))))
    want = [
        (i, len(t.encode()), n, n > 512)
        for i, t in enumerate(texts)
        for n in [len(library.encode(t, add_special_tokens=False).ids)]
    ]
    assert collected(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    rows = token_counts.count_tokens(odd)
    assert rows.count() == len(ODD)
    assert rows.where("doc_id IN (2, 3)").agg(F.sum("n_tokens")).first()[0] == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        token_counts.Vocabulary("/opt/tokenizers/word_bpe_49k.json")


# ------------------------------------------------------------------ classifiers
def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def labelled(make_docs, spark, n=240):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeioudnrst") for _ in range(rng.randint(2, 7)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 60))]
        bad, toxic = i % 4 == 0, i % 5 == 1
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["zzinsult", "qqslur"])
        docs.append((i, " ".join(w + "###" for w in words) if bad else " ".join(words)))
        labels.append((i, int(not bad), int(toxic)))
    return make_docs(docs), labels_of(spark, labels), labels


@pytest.mark.parametrize("module, column", [(quality_classifier, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy(make_docs, spark, module, column):
    docs, labels, truth = labelled(make_docs, spark)
    got = {r["doc_id"]: r for r in module.classify(docs, labels).collect()}
    want = {i: (q if column == "quality" else t) for i, q, t in truth}
    folds, held = module.FOLDS, module.HELD_OUT
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % folds == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    out = [i for i in got if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == want[i] for i in out]) >= 0.95


@pytest.mark.parametrize("module", [quality_classifier, toxicity])
def test_held_out_labels_are_never_used(make_docs, spark, module):
    docs, labels, truth = labelled(make_docs, spark, 90)
    held = lambda i: zlib.crc32(str(i).encode()) % module.FOLDS == module.HELD_OUT
    turned = labels_of(spark, [(i, 1 - q if held(i) else q, 1 - t if held(i) else t) for i, q, t in truth])
    same = [collected(module.classify(docs, x), "doc_id", "score") for x in (labels, turned)]
    assert same[0] == same[1]


@pytest.mark.parametrize("module", [quality_classifier, toxicity])
def test_odd_rows_and_missing_labels(clashing, make_docs, spark, module):
    nulls = labels_of(spark, [(1, None, None), (None, 1, 1), (5, 1, 1), (5, 0, 0), (5, 1, 1)])
    for labels in (nulls, nulls.where("doc_id < 0")):
        got = module.classify(clashing, labels).collect()
        assert len(got) == len(ODD)
        empty = {r["score"] for r in got if r["doc_id"] in (2, 3, 4)}
        assert len(empty) == 1 and all(0 <= s <= 1 for s in empty)
    none = make_docs([(1, "a")]).where("doc_id < 0")
    assert module.classify(none, nulls).count() == 0


def test_keep_has_the_input_columns(clashing, spark):
    got = quality_classifier.keep(clashing, labels_of(spark, []))
    assert got.columns == clashing.columns and got.count() == len(ODD)


def test_pairs_weigh_more_than_their_terms():
    """Only a and b together mark class 1: linear weights cannot tell."""
    rng = np.random.default_rng(5)
    rows, y = [], []
    for i in range(800):
        a, b = i % 2, i // 2 % 2
        rows.append(np.unique(np.concatenate([[1] * a, [2] * b, rng.integers(10, 400, 6)]).astype(np.int32)))
        y.append(int(a == b))
    model = toxicity._learn(rows, np.array(y), np.array([1, 2], np.int32))
    value = {s: toxicity.raw(model, np.array(s, int)) for s in [(), (0,), (1,), (0, 1)]}
    assert value[()] > 0 > value[(0,)] and value[(0, 1)] > 0 > value[(1,)]


def test_machine_equals_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    model = {"w0": 0.3, "w": rng.normal(size=9), "v": rng.normal(size=(9, toxicity.FACTORS))}
    for size in range(10):
        row = rng.permutation(9)[:size]
        plain = model["w0"] + sum(model["w"][i] for i in row)
        plain += sum(model["v"][i] @ model["v"][j] for a, i in enumerate(row) for j in row[a + 1 :])
        assert toxicity.raw(model, row) == pytest.approx(plain)


def test_fit_equals_a_plain_one(monkeypatch):
    """The same steps text by text and term by term."""
    monkeypatch.setattr(toxicity, "ROUNDS", 2)
    rng = np.random.default_rng(4)
    y = np.array([i % 3 == 0 for i in range(150)], int)
    rows = [np.unique(rng.integers(0, 12, 5)).astype(np.int32) for _ in y]
    chosen = np.array([0, 2, 3, 5, 7, 11], np.int32)
    got = toxicity._learn(rows, y, chosen)
    rng, f = np.random.default_rng(11), toxicity.FACTORS
    value = np.concatenate([[0.0], np.zeros(6), rng.normal(0, 0.02, (6, f)).ravel()])
    first, second, step = np.zeros_like(value), np.zeros_like(value), 0
    number = {t: i for i, t in enumerate(chosen.tolist())}
    weight = {c: len(y) / (2 * sum(y == c)) for c in (0, 1)}
    for _ in range(2):
        order = rng.permutation(len(y))
        for at in range(0, len(y), toxicity.BATCH):
            part = order[at : at + toxicity.BATCH]
            slope = toxicity.DECAY * value
            for i in part:
                row = [number[t] for t in rows[i].tolist() if t in number]
                if rng.random() >= toxicity.WHOLE:
                    row = [t for t, u in zip(row, rng.random(len(row)) < rng.random()) if u]
                v = value[7:].reshape(6, f)
                z = value[0] + sum(value[1 + t] for t in row)
                z += sum(v[a] @ v[b] for k, a in enumerate(row) for b in row[k + 1 :])
                miss = weight[y[i]] * (1 / (1 + np.exp(-z)) - y[i]) / len(part)
                slope[0] += miss
                for a in row:
                    slope[1 + a] += miss
                    slope[7 + a * f : 7 + (a + 1) * f] += miss * sum((v[b] for b in row if b != a), np.zeros(f))
            step += 1
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
            rate = toxicity.RATE * (1 - step / (2 * 3 + 1))
            value = value - rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    want = (value[0], value[1:7], value[7:].reshape(6, f))
    assert all(np.allclose(a, b) for a, b in zip((got["w0"], got["w"], got["v"]), want))


def test_short_toxic_texts_in_four_languages():
    """A prefix that is an insult in one language only, and one insult in a text."""
    rng = np.random.default_rng(6)
    languages = [[f"{c}{i}" for i in range(60)] for c in "pqrs"]
    insults = ["idiot", "loser", "scumbag", "clown", "moron"]

    def text(language, length, insult=None):
        words = [languages[language][int(i)] for i in 60 * rng.random(length) ** 2]
        if language == 1 and rng.random() < 0.2:
            words.append("losend")  # an ordinary word there
        return " ".join(words + ([insult] if insult else []))

    known, rows, y = toxicity.Terms(), [], []
    for i in range(2400):
        toxic = i % 6 == 0
        extra = " ".join(rng.choice(insults, rng.integers(1, 6))) if toxic else None
        rows.append(known.of(text(int(rng.integers(4)), int(rng.integers(20, 200)), extra)))
        y.append(int(toxic))
    model = toxicity.fit(rows, np.array(y))
    number = toxicity.Terms({int(t): i for i, t in enumerate(model["terms"])})
    score = lambda t: toxicity.score(model, number.of(t))
    found = [score(text(k, n, w)) >= 0.5 for k in range(4) for w in insults for n in (0, 4, 20, 150)]
    assert np.mean(found) >= 0.95
    assert np.mean([score(text(i % 4, 5 + i)) < 0.5 for i in range(200)]) >= 0.98


def test_pairs_are_learned_by_the_whole_fit():
    """Two terms, each as frequent in either class, mark class 1 only together."""
    rng = np.random.default_rng(8)

    def made(n):
        rows, y = [], []
        for i in range(n):
            a, b = i % 2, i // 2 % 2
            terms = np.concatenate([[1] * a, [2] * b, rng.integers(10, 2000, 6)])
            rows.append(np.unique(terms).astype(np.int32))
            y.append(int(a == b))
        return rows, np.array(y)

    model = toxicity.fit(*made(3000))
    number = {int(t): i for i, t in enumerate(model["terms"])}
    assert {1, 2} <= set(number)
    rows, y = made(400)
    right = [
        (toxicity.raw(model, np.array([number[t] for t in r if t in number], int)) > 0) == bool(label)
        for r, label in zip(rows, y)
    ]
    assert np.mean(right) >= 0.9


def test_dual_coordinate_descent_is_optimal():
    """The hinge-loss objective equals the dual value at the solution."""
    rng = np.random.default_rng(6)
    rows = [np.sort(rng.choice(50, 8, replace=False)).astype(np.int32) for _ in range(60)]
    y = np.array([int(r[0] < 5) for r in rows])
    scaled = [rng.normal(size=8) for _ in rows]
    rounds, quality_classifier.ROUNDS = quality_classifier.ROUNDS, 2000
    try:
        w, bias = quality_classifier.dual_coordinate_descent(rows, scaled, y)
    finally:
        quality_classifier.ROUNDS = rounds
    cost = quality_classifier.COST * len(y) / (2 * np.bincount(y))[y]

    def loss(w, bias):
        m = np.array([w[r] @ v + bias for r, v in zip(rows, scaled)]) * np.where(y == 1, 1, -1)
        return 0.5 * (w @ w + bias * bias) + (cost * np.maximum(0, 1 - m)).sum()

    best = loss(w, bias)
    for _ in range(200):
        assert loss(w + rng.normal(size=len(w)) * 1e-2, bias + rng.normal() * 1e-2) >= best - 1e-9


# ------------------------------------------------------------------ URL filters
def as_regex(glob):
    parts = re.split(r"(\*+|\?)", glob)
    return re.compile(
        "".join(
            ".*" if p.startswith("**") else "[^/]*" if p == "*" else "." if p == "?" else re.escape(p)
            for p in parts
        ),
        re.DOTALL,
    )


def test_automaton_equals_regular_expressions():
    rng = random.Random(7)
    for _ in range(40):
        globs = ["".join(rng.choice("ab/.*?é*") for _ in range(rng.randint(0, 12))) for _ in range(60)]
        texts = ["".join(rng.choice("ab/.éX日") for _ in range(rng.randint(0, 12))) for _ in range(80)]
        found = url_filters.Automaton(globs).fits(texts)
        for i, text in enumerate(texts):
            for j, glob in enumerate(globs):
                assert found[i, j] == bool(as_regex(glob).fullmatch(text)), (glob, text)


def test_rules(spark):
    urls = {
        "https://Sub.Example.ORG/es/x?q#f": ("sub.example.org", "/es/x", "example.org/es/", "block"),
        "http://example.org/en/19": ("example.org", "/en/19", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "x://a.com/de/1://b": ("a.com", "/de/1://b", "com/de/", "block"),
        "x://a.com/es/": ("a.com", "/es/", None, "allow"),
        "x://spam-farm.net/es/": ("spam-farm.net", "/es/", None, "block"),
        "x://com": ("com", "", None, "allow"),
        "x://org/": ("org", "/", "org/", "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "x://é.org/" + "y" * 100_000: ("é.org", "/" + "y" * 100_000, "org/", "allow"),
    }
    rows = [(i, url) for i, url in enumerate(urls)] + [(99, None), (99, None), (None, "x://org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(1))
    got = url_filters.filter_urls(pages)
    want = [(i, *v) for i, v in enumerate(urls.values())]
    want += [(99, "", "", None, "allow")] * 2 + [(None, "org", "/", "org/", "allow")]
    assert collected(got, "page_id", "host", "path", "rule", "verdict") == sorted(want, key=repr)
    assert url_filters.filter_urls(pages.where("page_id < 0")).count() == 0
