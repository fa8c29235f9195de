"""WARC archives in seekable Zstandard bundles.

Every page becomes one WARC/1.1 record. Of pages with equal payloads of at
least ``LEAST_REVISIT`` bytes one is a response, the others are revisits that
name it and carry no payload of their own.

A bundle is one file: independent Zstandard frames of about ``FRAME_BYTES`` of
whole records each (a longer record has a frame of its own), a skippable frame
with the record map (identifier, page, frame, offset in the frame, length), and
as its last frame the seek table of the seekable format, whose footer ends the
file. Any Zstandard reader reads the file as plain WARC; ``parse_bundle`` finds
a record from the footer alone, and a reader decompresses only its frame.

Tasks make bundles of about ``BUNDLE_BYTES`` from their own rows, so writing
moves no rows but those that the choice of responses needs. Spark writes and
reads the files, so any store that Spark reaches will do; a task that is run
again replaces its files. Files carry Spark's names, ending in ``.txt``: bundles
are written by the text source, with the footer's last four bytes as the line
ending and one line a file, which gives exactly the bytes of the bundle.

Defined results: a null payload is empty; a null or empty url gives no target
header; of equal payloads the smallest page_id responds, a null one last, and of
rows equal in both exactly one; a revisit of a page without page_id refers to
null; a payload of any length is one record; an empty table gives no bundle and
an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import ship, stored
from clickloom.session import fresh_folder

LEAST_REVISIT = 100
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20
LEVEL = 3
SMALL = 100_000  # shared payloads (about 100 bytes each) that may be broadcast
HOT_SHARE = 1_000  # payloads on more than 1/1000 of the rows number under 1000
DATE = "1970-01-01T00:00:00Z"  # pages carry no date

# Fixed values of the formats.
SKIPPABLE_MAP, SKIPPABLE_SEEK = 0x184D2A5D, 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_FOOTER_TEXT = struct.pack("<I", FOOTER_MAGIC).decode("latin-1")
_RECORD = "page_id bigint, record_id string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"
_PLACE = "bundle string, frame int, offset bigint, length bigint"


def payload_digest(html: Column) -> Column:
    return F.sha2(F.coalesce(html, F.lit("")), 256)


def plan(pages: DataFrame) -> DataFrame:
    """row, page_id, url, html, digest and, for revisits, ``first`` (row and page_id of the response)."""
    rows = stored(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("page_id").cast("long").alias("page_id"),
            "url",
            "html",
            payload_digest(F.col("html")).alias("digest"),
            F.coalesce(F.octet_length("html"), F.lit(0)).alias("size"),
        ),
        "warc-pages",
    )
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "row")
    shared = stored(
        rows.where(F.col("size") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
        .where("n > 1"),
        "warc-shared",
    )
    known = shared.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    found = shared.select("digest", F.struct("first.row", "first.page_id").alias("first"))
    if known["groups"] <= SMALL:
        joined = rows.join(F.broadcast(found), "digest", "left")
    else:
        # Payloads on many rows are few, so they are joined in place.
        hot = shared.where(F.col("n") * HOT_SHARE > known["rows"]).select("digest")
        frequent = rows.join(F.broadcast(hot), "digest", "left_semi").join(
            F.broadcast(found.join(hot, "digest", "left_semi")), "digest", "left"
        )
        rest = rows.join(F.broadcast(hot), "digest", "left_anti").join(found, "digest", "left")
        joined = frequent.unionByName(rest)
    revisit = F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))
    return joined.withColumn("first", F.when(revisit, F.col("first"))).drop("size")


def record_id(row: int) -> str:
    """A URN that only this row of the archive has."""
    digest = hashlib.sha256(f"record {row}".encode()).hexdigest()
    return f"urn:uuid:{digest[:8]}-{digest[8:12]}-5{digest[13:16]}-8{digest[17:20]}-{digest[20:32]}"


def record(row: int, page_id: int | None, url: str | None, payload: bytes, digest: str, first: dict | None) -> bytes:
    """One WARC record; ``first`` makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first else http + payload
    # A header value is one line; other bytes than printable ASCII are percent-encoded.
    target = "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if first else 'response'}",
        f"WARC-Record-ID: <{record_id(row)}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {target}"] if target else []),
        *([f"X-Page-ID: {page_id}"] if page_id is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if first:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_id(first['row'])}>"]
        head += [f"X-Refers-To-Page-ID: {first['page_id']}"] if first["page_id"] is not None else []
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class Bundle:
    """A bundle in the making."""

    def __init__(self, level: int = LEVEL):
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.frames: list[bytes] = []
        self.sizes: list[int] = []
        self.open: list[bytes] = []
        self.filled = self.whole = 0
        self.places: list[list] = []

    def add(self, name: str, page_id: int | None, content: bytes, frame_bytes: int) -> None:
        if self.open and self.filled + len(content) > frame_bytes:
            self.close_frame()
        self.places.append([name, page_id, len(self.frames), self.filled, len(content)])
        self.open.append(content)
        self.filled += len(content)
        self.whole += len(content)

    def close_frame(self) -> None:
        if self.open:
            self.frames.append(self.compressor.compress(b"".join(self.open)))
            self.sizes.append(self.filled)
            self.open, self.filled = [], 0

    def content(self) -> bytes:
        """The bytes of the file, without the footer's last four."""
        self.close_frame()
        where = self.compressor.compress(json.dumps(self.places).encode())
        where = _skippable(SKIPPABLE_MAP, where)
        table = b"".join(struct.pack("<II", len(f), n) for f, n in zip(self.frames, self.sizes))
        # The map is an entry of the table, as all frames before the table are.
        table += struct.pack("<II", len(where), 0)
        footer = struct.pack("<IB", len(self.frames) + 1, 0)
        seek = struct.pack("<II", SKIPPABLE_SEEK, len(table) + len(footer) + 4) + table + footer
        return b"".join([*self.frames, where, seek])


def parse_bundle(content: bytes) -> tuple[list[tuple[int, int, int]], list[list]]:
    """Frames (start, length, length of the content) and the record map, from the footer."""
    count, flags, magic = struct.unpack_from("<IBI", content, len(content) - 9)
    if magic != FOOTER_MAGIC or flags:
        raise ValueError("no seekable Zstandard bundle")
    at = len(content) - 9 - 8 * count
    start, frames = 0, []
    for i in range(count):
        packed, size = struct.unpack_from("<II", content, at + 8 * i)
        frames.append((start, packed, size))
        start += packed
    start, packed, _ = frames.pop()
    return frames, json.loads(zstandard.ZstdDecompressor().decompress(content[start + 8 : start + packed]))


def frame_content(content: bytes, frame: tuple[int, int, int]) -> bytes:
    start, packed, size = frame
    return zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=size)


def parse_record(content: bytes) -> dict:
    """Headers and payload of one record; the payload of a response is held against its digest."""
    head, _, block = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = block[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {headers['WARC-Record-ID']} differs from its digest")
    number = lambda name: int(headers[name]) if name in headers else None
    return {
        "page_id": number("X-Page-ID"),
        "record_id": headers["WARC-Record-ID"].strip("<>"),
        "record_type": kind,
        "payload_bytes": int(http.rpartition(b"Content-Length: ")[2]),
        "payload_digest": digest,
        "refers_to": number("X-Refers-To-Page-ID"),
        "refers_to_id": headers.get("WARC-Refers-To", "").strip("<>") or None,
        "url": headers.get("WARC-Target-URI"),
        "payload": payload if kind == "response" else None,
    }


def _bundles(frame_bytes: int, bundle_bytes: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row_of(bundle: Bundle) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([bundle.content()], pa.binary())], ["content"])

        bundle = Bundle()
        for batch in batches:
            columns = [batch.column(c) for c in ("row", "page_id", "url", "html", "digest", "first")]
            for i in range(len(batch)):
                row, page_id, url, html, digest, first = (c[i].as_py() for c in columns)
                payload = (html or "").encode("utf-8", "surrogatepass")
                bundle.add(record_id(row), page_id, record(row, page_id, url, payload, digest, first), frame_bytes)
                if bundle.whole >= bundle_bytes:
                    yield row_of(bundle)
                    bundle = Bundle()
        if bundle.places:
            yield row_of(bundle)

    return make


def write_archive(
    pages: DataFrame, path: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> None:
    """All pages as bundles below ``path``, which must be new."""
    ship(pages.sparkSession)
    bundles = plan(pages).select("row", "page_id", "url", "html", "digest", "first").mapInArrow(
        _bundles(frame_bytes, bundle_bytes), "content binary"
    )
    (
        bundles.select(F.col("content").cast("string").alias("value"))
        .write.option("lineSep", _FOOTER_TEXT)
        .option("encoding", "ISO-8859-1")
        .option("compression", "none")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    # A table without rows leaves one empty file.
    return files.where("length > 0").select(F.element_at(F.split("path", "/"), -1).alias("bundle"), "content")


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _read(with_payload: bool):
    fields = [
        ("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
    ]
    schema = pa.schema(fields + [("url", pa.string()), ("payload", pa.binary())] * with_payload)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("places") if "places" in batch.schema.names else None
            for i in range(len(batch)):
                content = batch.column("content")[i].as_py()
                frames, places = parse_bundle(content)
                if wanted is not None:
                    places = [[None, None, p["frame"], p["offset"], p["length"]] for p in wanted[i].as_py()]
                by_frame: dict[int, list] = {}
                for place in places:
                    by_frame.setdefault(place[2], []).append(place)
                for number, inside in by_frame.items():
                    whole = frame_content(content, frames[number])
                    found = [parse_record(whole[at : at + n]) for _, _, _, at, n in inside]
                    yield _batch([{c: r[c] for c in schema.names} for r in found], schema)

    return read


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_id, record_type, payload_bytes, payload_digest and refers_to of every record.

    One bundle at a time is in a worker's memory, and one of its frames unpacked.
    """
    ship(spark)
    return _files(spark, path).select("content").mapInArrow(_read(False), _RECORD)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("record_id", pa.string()), ("page_id", pa.int64()), ("bundle", pa.string()),
         ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
    )
    for batch in batches:
        for i in range(len(batch)):
            _, places = parse_bundle(batch.column("content")[i].as_py())
            bundle = batch.column("bundle")[i].as_py()
            names = ("record_id", "page_id", "frame", "offset", "length")
            yield _batch([dict(zip(names, p)) | {"bundle": bundle} for p in places], schema)


def record_map(spark: SparkSession, path: str) -> DataFrame:
    """record_id, page_id, bundle, frame, offset and length of every record, from the bundles' maps."""
    ship(spark)
    return _files(spark, path).mapInArrow(_places, f"record_id string, page_id bigint, {_PLACE}")


def fetch(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """Whole records at ``places`` (rows of ``record_map``), with url and payload, each once.

    Only the bundles that hold one are passed on, and only its frames unpacked.
    A revisit has no payload: fetch the record it refers to.
    """
    ship(spark)
    # Each place once, so no more than a bundle has records.
    wanted = places.groupBy("bundle").agg(F.collect_set(F.struct("frame", "offset", "length")).alias("places"))
    return (
        _files(spark, path)
        .join(wanted, "bundle")
        .select("content", "places")
        .mapInArrow(_read(True), f"{_RECORD}, url string, payload binary")
    )


def archive(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a new archive below the shared folder and read it back."""
    spark = pages.sparkSession
    path = fresh_folder(spark, "warc")
    write_archive(pages, path)
    return read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
