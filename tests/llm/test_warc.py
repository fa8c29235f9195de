"""WARC bundles: exact round trips and the choice of responses."""

import hashlib
import io
import random
import re

import zstandard
from llm_cases import collected
from pyspark.sql import functions as F

from clickloom.llm import warc

SCHEMA = "page_id long, url string, html string"
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def brute(rows):
    groups = {}
    for i, (page_id, _, html) in enumerate(rows):
        payload = (html or "").encode()
        groups.setdefault(payload, []).append((page_id is None, page_id or 0, i))
    out = []
    for i, (page_id, _, html) in enumerate(rows):
        payload = (html or "").encode()
        first = min(groups[payload])
        revisit = len(payload) >= 100 and first[2] != i
        out.append(
            (page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response",
             rows[first[2]][0] if revisit else None)
        )
    return sorted(out, key=repr)


LONG = "<p>" + "word é " * 200_000
ODD = [
    (1, "http://a.org/", "<p>" + "x" * 96),  # 99 bytes
    (2, "http://a.org/", "<p>" + "x" * 96),
    (3, "http://a.org/", "<p>" + "x" * 97),  # 100 bytes
    (4, "http://a.org/2", "<p>" + "x" * 97),
    (4, "http://a.org/2", "<p>" + "x" * 97),
    (None, None, "<p>" + "x" * 97),
    (None, "", None),
    (5, "http://b.org/ä b\r\nInjected: 1", ""),
    (6, "http://b.org", "\r\n\r\nContent-Length: 3\r\n\r\n" + "WARC/1.1\r\n" * 20),
    (7, "u", LONG),
    (2, "u", LONG),
    (8, "u", None),
]


def test_equals_brute_force(spark):
    pages = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    for extra in ("row", "digest", "first", "size", "content", "bundle", "places", "n"):
        pages = pages.withColumn(extra, F.lit("x"))
    assert collected(warc.archive(pages), *COLUMNS) == brute(ODD)


def test_large_groups_and_small_bundles(spark, folder):
    rng = random.Random(2)
    rows = [(i, f"http://h/{i}", "same " * 40 if i % 3 else f"page {rng.randrange(60)} " * 20) for i in range(900)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(4)
    warc.write_archive(pages, f"{folder}/a", frame_bytes=1000, bundle_bytes=9000)
    got = warc.read_archive(spark, f"{folder}/a")
    assert collected(got, *COLUMNS) == brute(rows)
    assert got.select("record_id").distinct().count() == 900
    small, warc.SMALL = warc.SMALL, 3  # the way for many shared payloads
    try:
        warc.write_archive(pages, f"{folder}/b")
    finally:
        warc.SMALL = small
    assert collected(warc.read_archive(spark, f"{folder}/b"), *COLUMNS) == brute(rows)


def test_bundles_are_plain_zstandard_and_seekable(spark, folder):
    rows = [(i, f"http://h/{i}", f"<p>page {i} " * (1 + i % 40)) for i in range(300)]
    warc.write_archive(spark.createDataFrame(rows, SCHEMA).repartition(2), f"{folder}/a", 2000, 20_000)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/a").collect()
    assert len(files) > 3
    seen = []
    for file in files:
        content = bytes(file["content"])
        assert content[-4:] == b"\xb1\xea\x92\x8f"
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True).read()
        frames, places = warc.parse_bundle(content)
        assert plain == b"".join(warc.frame_content(content, f) for f in frames)
        assert sum(size for *_, size in frames) == len(plain) and len(frames) > 3
        for name, page_id, frame, offset, length in places:
            part = warc.frame_content(content, frames[frame])[offset : offset + length]
            assert part.startswith(b"WARC/1.1\r\n") and part.endswith(b"\r\n\r\n")
            assert f"<{name}>".encode() in part
            seen.append(page_id)
        # a reader that knows WARC alone finds the same records one behind the other
        at = 0
        while at < len(plain):
            head = plain[at : plain.index(b"\r\n\r\n", at)]
            length = int(re.search(rb"\r\nContent-Length: (\d+)$", head)[1])
            at += len(head) + 4 + length + 4
        assert at == len(plain)
    assert sorted(seen) == list(range(300))


def test_fetch_by_identifier(spark, folder):
    rows = [(i, f"http://h/{i}", f"<p>page é {i % 250} " * 20) for i in range(300)]
    warc.write_archive(spark.createDataFrame(rows, SCHEMA), f"{folder}/a", 2000, 20_000)
    places = warc.record_map(spark, f"{folder}/a")
    assert places.count() == 300
    wanted = places.where("page_id % 100 = 7 OR page_id = 280")
    got = {r["page_id"]: r for r in warc.fetch(spark, f"{folder}/a", wanted.unionByName(wanted)).collect()}
    assert set(got) == {7, 107, 207, 280}
    assert bytes(got[107]["payload"]).decode() == rows[107][2] and got[107]["url"] == "http://h/107"
    assert (got[280]["record_type"], got[280]["refers_to"], got[280]["payload"]) == ("revisit", 30, None)


def test_a_changed_payload_is_found():
    digest = hashlib.sha256(b"abc").hexdigest()
    content = warc.record(1, 1, "u", b"abc", digest, None)
    assert warc.parse_record(content)["payload"] == b"abc"
    try:
        warc.parse_record(content.replace(b"abc\r\n", b"abd\r\n"))
    except ValueError:
        return
    raise AssertionError("a changed payload was read")


def test_empty_table(spark):
    assert warc.archive(spark.createDataFrame([], SCHEMA)).count() == 0
