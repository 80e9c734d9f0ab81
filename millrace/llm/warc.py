"""WARC archives: writing, reading and segment reassembly.

A page becomes a response record with an HTTP block in chunked transfer
framing, or a revisit record if a page with the same payload and a smaller id
is archived as response.  A block longer than ``segment_bytes`` is continued in
``continuation`` records that name the first by its record id, carry their
segment number, and end with the total length.  Every record is a gzip member
of its own, as the format recommends.

The files are written by Spark's text writer, hence with its commit protocol
and to any file system that Spark can write.  That writer ends each value with
a separator; a gzip member of under 16 MiB ends with a zero byte, so members
are handed over without it and the separator is that byte.

Reading groups the continuation records by origin, orders them by segment
number, checks that the numbers are complete and the total length is right,
and decodes the chunks.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import join_spread, materialize, scratch

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
MEMBER_LIMIT = 16 << 20
GZIP_LEVEL = 6
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(row: int, segment: int = 1) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{row}/{segment}')}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunk(body: bytes) -> bytes:
    """Payload of a chunked body; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """Payload of an HTTP response block, chunked or plain."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("no end of the HTTP header")
    is_chunked = any(k.strip().lower() == b"transfer-encoding" and b"chunked" in v.lower() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:]))
    return unchunk(body) if is_chunked else body


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """One gzip member without its last byte, which is zero below 16 MiB."""
    if len(record) >= MEMBER_LIMIT:
        raise ValueError("a record must stay below 16 MiB; use smaller segments")
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    raw = packer.compress(record) + packer.flush()
    return raw[:-1]


def page_records(row: int, page_id: int | None, url: str | None, payload: bytes, digest: str, origin: tuple[int, int | None] | None, segment_bytes: int) -> Iterator[bytes]:
    """The WARC records of one page.  ``origin`` names the response (row,
    page_id) that a revisit refers to."""
    common = [("WARC-Date", DATE), ("X-Page-Id", "" if page_id is None else str(page_id))]
    if url:
        common.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if origin is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(row)), *common, ("Content-Type", "application/http; msgtype=response"), ("WARC-Profile", PROFILE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Refers-To", record_id(origin[0]))], HTTP_HEAD)
        return
    block = HTTP_HEAD + chunked(payload)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", record_id(row)), *common, ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if len(parts) > 1:
        first.append(("WARC-Segment-Number", "1"))
    yield _record(first, parts[0])
    for number, part in enumerate(parts[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(row, number)), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", record_id(row)), ("WARC-Segment-Number", str(number))]
        if number == len(parts):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record(more, part)


_STORED = "row bigint, page_id bigint, url string, payload binary, digest string, n bigint, strong binary"


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their digest, and the payload compressed for the shuffle."""
    for batch in batches:
        payloads = [p.as_py() for p in batch.column(3)]
        packer = zstandard.ZstdCompressor(level=3)
        columns = [pa.array([packer.compress(p) for p in payloads], pa.binary()), pa.array([sha1_base32(p) for p in payloads]), pa.array([len(p) for p in payloads], pa.int64()), pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary())]
        yield pa.record_batch([*batch.columns[:3], *columns], names=[f.split()[0] for f in _STORED.split(", ")])


def write_archives(pages: DataFrame, out: str, segment_bytes: int = SEGMENT_BYTES, least_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files under ``out``.

    Of pages with equal payloads of at least ``least_bytes`` bytes, the one
    with the smallest page_id (null last, then the first row) is the response.
    Payloads count as equal by their SHA-256; the SHA-1 is just what WARC shows.
    """
    body = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    source = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("bigint").alias("page_id"), url.alias("url"), body.alias("payload"))
    rows = materialize(source.mapInArrow(_stored, _STORED), "warc-rows")
    first = F.struct(F.col("page_id").isNull().alias("a"), F.col("page_id").alias("b"), F.col("row").alias("c"))
    # who is whose copy is decided on narrow rows, and payloads go by row
    narrow = rows.where(F.col("n") >= least_bytes).select("row", "page_id", "strong")
    shared = narrow.groupBy("strong").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    shared = shared.select("strong", F.col("first.c").alias("to_row"), F.col("first.b").alias("to_page"))
    revisits = join_spread(narrow.select("row", "strong"), shared, "strong", rows, by="row").where("to_row != row")
    dealt = rows.join(revisits.select("row", "to_row", "to_page"), "row", "left")
    dealt = dealt.select("row", "page_id", "url", F.when(F.col("to_row").isNull(), F.col("payload")).alias("payload"), "digest", "to_row", "to_page")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[bytes] = []
            held = 0
            for row, page_id, link, packed, digest, to_row, to_page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                origin = None if to_row is None else (to_row, to_page)
                payload = b"" if packed is None else zstandard.ZstdDecompressor().decompress(packed)
                for record in page_records(row, page_id, link, payload, digest, origin, segment_bytes):
                    made.append(member(record))
                    held += len(made[-1])
                if held > 16 << 20:
                    yield pa.record_batch([pa.array(made, pa.binary())], names=["member"])
                    made, held = [], 0
            yield pa.record_batch([pa.array(made, pa.binary())], names=["member"])

    members = dealt.mapInArrow(run, "member binary")
    members.select(F.col("member").cast("string").alias("member")).write.mode("overwrite").option("compression", "none").option("lineSep", "\0").text(out)


def iter_members(data: memoryview, step: int = 1 << 16) -> Iterator[bytes]:
    """Records of a file: gzip members one by one, fed in small steps."""
    at, n = 0, len(data)
    while at < n:
        reader, parts = zlib.decompressobj(31), []
        while not reader.eof:
            if at >= n:
                raise ValueError("the last gzip member is cut off")
            piece = data[at : at + step]
            parts.append(reader.decompress(piece))
            at += len(piece) - len(reader.unused_data)
        yield b"".join(parts)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of uncompressed WARC bytes, by their content lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("a record does not start with its version")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = end + 4
        stop = start + int(headers["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield headers, data[start:stop]
        at = stop + 4


_RAW = "record_id string, warc_type string, page_id bigint, url string, payload_digest string, refers_to_id string, origin_id string, segment int, total bigint, block binary"
_KINDS = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary())


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Raw records of the gzip or plain WARC files under ``path``."""

    def row(h: dict[str, str], block: bytes) -> tuple:
        number = lambda k: int(h[k]) if h.get(k) else None
        return (h.get("warc-record-id"), h.get("warc-type"), number("x-page-id"), h.get("warc-target-uri"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None, h.get("warc-refers-to"), h.get("warc-segment-origin-id"), number("warc-segment-number"), number("warc-segment-total-length"), block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = memoryview(content.as_buffer())
                found = iter_members(data) if bytes(data[:2]) == b"\x1f\x8b" else iter([bytes(data)])
                rows, held = [], 0
                for raw in found:
                    for headers, block in parse_records(raw):
                        rows.append(row(headers, block))
                        held += len(block)
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, _RAW)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_KINDS)
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, _KINDS, strict=True)], names=[f.split()[0] for f in _RAW.split(", ")])


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: record_id, warc_type, page_id, url, payload_digest,
    refers_to_id, payload.  Segments are put together by origin; a missing
    segment or a wrong total length is an error."""
    key = F.coalesce("origin_id", "record_id")
    kept = ["record_id", "warc_type", "page_id", "url", "payload_digest", "refers_to_id", "total", "parts"]
    single = records.where("segment IS NULL").withColumn("parts", F.array(F.struct("segment", "block"))).select(*kept)
    head = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    split = records.where("segment IS NOT NULL").groupBy(key.alias("record_id"))
    whole = split.agg(*map(head, kept[1:6]), F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    both = single.unionByName(whole.select(*kept))
    schema = "record_id string, warc_type string, page_id bigint, url string, payload_digest string, refers_to_id string, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rid, kind, parts, total, digest in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("record_id", "warc_type", "parts", "total", "payload_digest")), strict=True):
                pieces = parts.as_py()
                raw, seen = b"".join(p["block"] for p in pieces), [p["segment"] for p in pieces]
                if seen != [None]:
                    if seen != list(range(1, len(seen) + 1)):
                        raise ValueError(f"{rid.as_py()}: segments {seen} are not complete")
                    if total.as_py() != len(raw):
                        raise ValueError(f"{rid.as_py()}: {len(raw)} bytes, but {total.as_py()} were announced")
                payload = None if kind.as_py() == "revisit" else payload_of(raw)
                if payload is not None and digest.as_py() not in (None, sha1_base32(payload)):
                    raise ValueError(f"{rid.as_py()}: the payload does not have its digest")
                out.append(payload)
            keep = [batch.column(batch.schema.get_field_index(c)) for c in ("record_id", "warc_type", "page_id", "url", "payload_digest", "refers_to_id")]
            yield pa.record_batch([*keep, pa.array(out, pa.binary())], names=["record_id", "warc_type", "page_id", "url", "payload_digest", "refers_to_id", "payload"])

    return both.mapInArrow(run, schema)


def archived_pages(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Pages of the archives under ``path``: page_id, url, record_type,
    payload_digest, payload_bytes, refers_to and, on request, payload (null
    for a revisit)."""
    whole = reassemble(read_records(spark, path)).withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    whole = materialize(whole if payloads else whole.drop("payload"), "warc-read")
    first = whole.where("warc_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("to_page"), F.col("payload_bytes").alias("to_bytes"))
    # responses refer to nothing: only revisits are joined, those of one page by several tasks
    revisits = join_spread(whole.where("refers_to_id IS NOT NULL"), first, "refers_to_id", how="left")
    alone = whole.where("refers_to_id IS NULL").withColumns({"to_page": F.lit(None).cast("bigint"), "to_bytes": F.lit(None).cast("bigint")})
    joined = alone.unionByName(revisits)
    return joined.select("page_id", "url", F.col("warc_type").alias("record_type"), "payload_digest", F.coalesce("payload_bytes", "to_bytes").alias("payload_bytes"), F.col("to_page").alias("refers_to"), *["payload"] * payloads)


def warc_round_trip(pages: DataFrame, out: str | None = None, segment_bytes: int = SEGMENT_BYTES, least_bytes: int = 0, payloads: bool = True) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) and read the archives back.

    A null html is an empty payload.  A null page_id is archived and comes
    back null, last among equals; repeated rows are one response and revisits
    of it; an empty table gives no page; further columns are ignored.
    """
    spark = pages.sparkSession
    path = out or scratch(spark, "warc")
    write_archives(pages, path, segment_bytes, least_bytes)
    return archived_pages(spark, path, payloads)
