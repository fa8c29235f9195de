"""Reconciliation by digests against a comparison of every key."""

import collections
import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom.operators import digests

SCHEMA = "k string, v double, w string"


def brute(left, right):
    """(key, left rows, right rows, status) of the keys that differ, one by one."""
    def by_key(table):
        found = collections.defaultdict(collections.Counter)
        for key, v, w in table:
            found[key][("nan" if v is not None and math.isnan(v) else v, w)] += 1
        return found

    a, b, out = by_key(left), by_key(right), []
    for key in set(a) | set(b):
        if key is not None and a[key] == b[key]:
            continue
        n, m = sum(a[key].values()), sum(b[key].values())
        kinds = [(key is None, "no_key"), (m == 0, "missing_right"), (n == 0, "missing_left"), (n != m, "row_count")]
        out.append((key, n, m, next((name for is_so, name in kinds if is_so), "changed")))
    return sorted(out, key=repr)


def both(spark, left, right):
    return (spark.createDataFrame(left, SCHEMA).repartition(5), spark.createDataFrame(right, SCHEMA).repartition(3))


def table(seed, n):
    rng = random.Random(seed)
    return [(f"k{i}", rng.choice([None, 0.0, 1.5, math.nan]), rng.choice([None, "", "ä"])) for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_every_difference_is_named(spark, seed):
    rng, left = random.Random(seed), table(seed, 300)
    right = [row for row in left if rng.random() > 0.05]
    right += [row for row in right if rng.random() < 0.05]
    right = [(f"x{k}" if rng.random() < 0.03 else k, 7.25 if rng.random() < 0.05 else v, w) for k, v, w in right]
    left += [(None, 1.0, "a")] * seed
    right += [(None, 1.0, "a")] * (seed % 3)
    got = digests.differing(*both(spark, left, right), "k", ["v", "w"])
    assert got.columns == ["k", "left_rows", "right_rows", "status"]
    assert rows(got) == brute(left, right)
    keys_only = [[(k, None, None) for k, *_ in side] for side in (left, right)]
    assert rows(digests.differing(*both(spark, left, right), "k")) == brute(*keys_only)


def test_equal_tables_in_any_order(spark):
    left = table(1, 500) * 2 + [("zero", -0.0, "b")]
    right = list(reversed(table(1, 500) * 2)) + [("zero", 0.0, "b")]
    frames = both(spark, left, right)
    assert digests.open_parts(*frames, "k", ["v", "w"]) == []
    assert digests.differing(*frames, "k", ["v", "w"]).isEmpty()
    assert digests.reconciliation(*frames, "k", ["v", "w"]).first().asDict() == {
        "missing_right": 0, "missing_left": 0, "repeated_keys": 0, "changed_keys": 0, "passed": True
    }


def test_rows_and_values_that_move_between_keys(spark):
    """Sums and counts of the whole stay the same; the digests do not."""
    left = [("a", 1.0, "x"), ("b", 2.0, "x"), ("c", 3.0, "x"), ("c", 3.0, "x")]
    right = [("a", 2.0, "x"), ("b", 1.0, "x"), ("c", 3.0, "x"), ("a", 2.0, "x")]
    assert rows(digests.differing(*both(spark, left, right), "k", ["v"])) == brute(left, right)
    twice = [("d", 1.0, "x")] * 2, [("d", 2.0, "x")] * 2  # an xor alone would not see it
    assert rows(digests.differing(*both(spark, *twice), "k", ["v"])) == [("d", 2, 2, "changed")]


def test_empty_tables_and_clashing_names(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame(table(2, 3), SCHEMA)
    assert digests.differing(none, none, "k").isEmpty()
    assert [r.status for r in digests.differing(some, none, "k").collect()] == ["missing_right"] * 3
    clash = some.select(F.col("k").alias("part"), F.col("v").alias("side"), F.col("w").alias("range"))
    assert digests.differing(clash, clash, "part", ["side", "range"]).isEmpty()
    assert digests.differing(clash, clash.limit(2), "part", ["side"]).columns[0] == "part"


def test_only_open_parts_are_exchanged(spark):
    """One changed row among 20,000: one small range is open, and few rows go by key."""
    left = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("double").alias("v"))
    right = left.withColumn("v", F.when(F.col("k") == "k77", -1.0).otherwise(F.col("v")))
    parts = digests.open_parts(left, right, "k", ["v"])
    assert len(parts) == 1
    hashed = F.shiftrightunsigned(F.xxhash64("k"), 64 - 16)
    assert left.where(hashed.isin(parts)).count() <= 5
    assert rows(digests.differing(left, right, "k", ["v"])) == [("k77", 1, 1, "changed")]
    plan = digests.differing(left, right, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("hashpartitioning") == 1


def test_a_key_with_a_third_of_the_rows(spark):
    hot = [("hot", 1.0, "x")] * 1000
    left, right = table(3, 200) + hot, table(3, 200) + hot[:-1]
    assert rows(digests.differing(*both(spark, left, right), "k", ["v", "w"])) == [("hot", 1000, 999, "row_count")]
