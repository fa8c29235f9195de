"""The index of accepted ids: what it reads, and that it never loses an id."""

import os
import shutil

import pytest
from conftest import make_events, rows
from pyspark.sql import functions as F

from clickloom.sources import landing
from clickloom.streaming import accepted, incremental


def write_batch(spark, root, number, start, end, indexed=True, prefix="e"):
    ids = spark.range(start, end).select(F.concat(F.lit(prefix), F.lpad(F.col("id").cast("string"), 9, "0")).alias("event_id"))
    ids.write.mode("overwrite").parquet(f"{root}/ok/batch={number}")
    if indexed:
        accepted.record(spark.read.parquet(f"{root}/ok/batch={number}"), f"{root}/index", number)


def asked(spark, *numbers, prefix="e"):
    return spark.createDataFrame([(f"{prefix}{n:09d}",) for n in numbers], "event_id string")


def to_read(ids, folder, number=99):
    return accepted.batches_to_read(ids, f"{folder}/ok", f"{folder}/index", number)


def test_only_batches_that_may_hold_an_id_are_read(spark, folder):
    # Spans overlap all over, so the filters have to tell: batch n holds the ids that end in digit n.
    for number in range(4):
        ids = spark.range(2000).where(F.col("id") % 4 == number)
        ids = ids.select(F.concat(F.lit("e"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("event_id"))
        ids.write.parquet(f"{folder}/ok/batch={number}")
        accepted.record(spark.read.parquet(f"{folder}/ok/batch={number}"), f"{folder}/index", number)
    assert to_read(asked(spark, 41, 1001), folder) == [1]
    assert to_read(asked(spark, 40, 43), folder) == [0, 3]
    assert to_read(asked(spark, 40, 43), folder, number=0) == [3]  # its own number is not asked
    assert to_read(asked(spark, 41, prefix="x"), folder) == []  # outside of every span
    before = accepted.accepted_before(asked(spark, 41, 41, 77777), f"{folder}/ok", f"{folder}/index", 99)
    assert rows(before) == [("e000000041",)]
    assert [p for p in before.inputFiles() if "batch=1/" not in p] == []


def test_every_accepted_id_is_found_and_few_others(spark, folder):
    write_batch(spark, folder, 0, 0, 30_000)
    known = spark.read.parquet(f"{folder}/ok/batch=0")
    found = accepted.accepted_before(known, f"{folder}/ok", f"{folder}/index", 1)
    assert found.count() == 30_000
    others = known.select(F.concat("event_id", F.lit("x")).alias("event_id"))
    # One id at a time would be slow: the filter's blocks are asked here as the operator asks them.
    digits = accepted._digits(30_000)
    masks = [m.alias(f"m{i}") for i, m in enumerate(accepted._masks())]
    blocks = spark.read.parquet(f"{folder}/index/blocks")
    hits = others.select(accepted._block(F.lit(digits)).alias("block"), *masks).join(blocks, "block")
    for i in range(accepted.LONGS):
        hits = hits.where(F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    assert hits.count() <= 6


def test_batches_without_index_are_always_read(spark, folder):
    write_batch(spark, folder, 0, 0, 10)
    write_batch(spark, folder, 1, 10, 20, indexed=False)
    assert to_read(asked(spark, 15), folder) == [1]
    assert to_read(asked(spark, 5), folder) == [0, 1]
    before = accepted.accepted_before(asked(spark, 15, 5, 25), f"{folder}/ok", f"{folder}/index", 2)
    assert rows(before) == [("e000000005",), ("e000000015",)]


@pytest.mark.parametrize("ids", [[], [None], ["", "é" * 500]])
def test_odd_ids(spark, folder, ids):
    nothing = spark.createDataFrame([], "event_id string")
    assert to_read(nothing, folder) == []  # no history
    frame = spark.createDataFrame([(i,) for i in ids], "event_id string")
    frame.write.parquet(f"{folder}/ok/batch=0")
    accepted.record(frame, f"{folder}/index", 0)
    assert to_read(nothing, folder) == []
    assert to_read(frame, folder) == ([0] if any(i is not None for i in ids) else [])
    found = accepted.accepted_before(frame, f"{folder}/ok", f"{folder}/index", 1)
    assert rows(found) == sorted((i,) for i in ids if i is not None)


def load(spark, folder):
    stream = incremental.landing_stream(spark, landing.landing_glob(f"{folder}/in"))
    incremental.gated_load(
        stream, f"{folder}/ok", f"{folder}/bad", f"{folder}/reports", f"{folder}/cp"
    ).awaitTermination(120)


def test_no_id_is_accepted_twice_when_batches_are_retried(spark, folder):
    """The second batch is retried as after a lost driver, with and without its index written."""
    def land(number, *ids):
        data = [("s", "u", "10:00:00", "search", {"event_id": i}) for i in ids]
        landing.write_batch(make_events(spark, data), number, f"{folder}/in")

    land(1, "a", "b")
    load(spark, folder)
    land(2, "b", "c")
    load(spark, folder)
    want = [("a", 0), ("b", 0), ("c", 1)]
    assert rows(spark.read.parquet(f"{folder}/ok"), "event_id", "batch") == want
    for lost in ([], ["spans"], ["spans", "blocks"]):
        for name in os.listdir(f"{folder}/cp/commits"):
            if name.strip(".").split(".")[0] == "1":
                os.remove(f"{folder}/cp/commits/{name}")
        for part in lost:
            shutil.rmtree(f"{folder}/ok-index/{part}/batch=1")
        load(spark, folder)
        assert rows(spark.read.parquet(f"{folder}/ok"), "event_id", "batch") == want
        assert rows(spark.read.parquet(f"{folder}/bad"), "event_id", "batch") == [("b", 1)]
        assert rows(spark.read.parquet(f"{folder}/ok-index/spans"), "batch", "ids") == [(0, 2), (1, 1)]
    land(3, "a", "c", "d")
    load(spark, folder)
    assert rows(spark.read.parquet(f"{folder}/ok"), "event_id", "batch") == [*want, ("d", 2)]
