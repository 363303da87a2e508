"""WARC archives with segmented records (operator 1).

Writing: each page becomes a ``response`` record holding an HTTP response with
a chunked body; of pages with equal payloads only the one with the smallest id
is stored in full, the others become ``revisit`` records that refer to it. A
block longer than ``segment_bytes`` is split into a first record and
``continuation`` records that carry the origin's record id and their number;
the last one carries the total length. Records are built as SQL expressions
and written by Spark's text writer, whose line separator is the two line ends
that close a WARC record: the files are committed like any other Spark output.

Reading: files are parsed record by record by their Content-Length. Segments
are grouped by origin id, ordered by segment number, and checked for gaps and
against the total length; then the chunked framing is decoded and the payload
checked against its digest. One task holds one record's segments at a time.

``status`` of a record read: ``ok``, ``truncated`` (the file ends inside it),
``missing_segment``, ``length_mismatch``, ``bad_chunk``, ``digest_mismatch``;
the payload is null unless the chunk framing could be decoded.

Defined cases: a null payload is written as empty; pages with a null id refer
to the smallest id with their payload, and are responses if there is none;
rows that repeat the smallest id of their payload are responses each; control
characters in a URL are percent-encoded in the header; an empty table writes
an archive without records and reads back as no rows. Columns other than id,
URL and payload are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from base64 import b32encode
from typing import BinaryIO, Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.common import salted_join

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
END = CRLF * 2
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_OUT_BYTES = 8 << 20

RECORDS = ("record_id string, type string, target_uri string, page_id string, refers_to string, header_digest string, "
           "origin string, segment int, total bigint, block binary, payload binary, payload_bytes bigint, status string")


def base32_sha1(data: Column) -> Column:
    """SHA-1 as base32: each 20 bits (five hex digits) are four base-32 digits."""
    digest = F.upper(F.sha1(data))
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), _BASE32_DIGITS, BASE32)


# ------------------------------------------------------------------ writing

def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, payload, ...`` with ``digest`` and ``refers_to``: the smallest id with an equal payload, null for itself.

    Payloads under ``min_bytes`` are never referred to.
    """
    rows = pages.withColumn("digest", base32_sha1(F.col("payload")))
    firsts = (  # one row per task and digest before the shuffle
        rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter((F.col("_n") > 1) & F.col("_first").isNotNull()).select("digest", "_first")
    )
    joined = salted_join(rows, firsts, {"digest": "digest"}, F.xxhash64("page_id"))
    other = (F.octet_length("payload") >= min_bytes) & F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.withColumn("refers_to", F.when(other, F.col("_first"))).drop("_first")


def chunked(payload: Column, chunk_bytes: int = CHUNK_BYTES) -> Column:
    """The payload in HTTP chunked framing, as a string of its bytes."""
    n = F.octet_length(payload)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(chunk_bytes))).otherwise(F.array().cast("array<int>"))
    size = lambda at: F.least(F.lit(chunk_bytes), n - at)
    chunk = lambda at: F.concat(
        F.lower(F.hex(size(at))), F.lit(CRLF), F.substr(payload, at + 1, size(at)).cast("string"), F.lit(CRLF))
    return F.concat(F.array_join(F.transform(starts, chunk), ""), F.lit(f"0{END}"))


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def records(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
            min_bytes: int = 0, date: str = DATE, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``value``: the archive's records as text, without the two line ends that close each."""
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit("").cast("binary")).alias("payload"),
    )
    rows = mark_revisits(rows, min_bytes).withColumn("record_id", F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")))
    head = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}")
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.concat(head, F.lit("Content-Length: "), F.octet_length("payload").cast("string"), F.lit(END))).otherwise(
        F.concat(head, F.lit(f"Transfer-Encoding: chunked{END}"), chunked(F.col("payload"), chunk_bytes)))
    blocks = rows.select("page_id", "url", "digest", "refers_to", "record_id", block.cast("binary").alias("block"))
    starts = F.sequence(F.lit(0), F.octet_length("block") - 1, F.lit(segment_bytes))
    cuts = blocks.select("*", F.posexplode(starts).alias("_i", "_at"))
    cuts = cuts.withColumn("part", F.substr(F.col("block"), F.col("_at") + 1, F.lit(segment_bytes)))
    n, size, first = F.octet_length("block"), F.octet_length("part"), F.col("_i") == 0
    split, last = n > segment_bytes, F.col("_at") + F.lit(segment_bytes) >= n
    uri = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A"), r"[\x00-\x20\x7F]", "%20")
    number = F.when(split, (F.col("_i") + 1).cast("string"))
    fields = [
        F.lit(VERSION + CRLF),
        _field("WARC-Type", F.when(~first, F.lit("continuation")).when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", F.when(first, F.col("record_id")).otherwise(F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", uri),
        _field("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("part")))),
        _field("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        _field("WARC-Profile", F.when(first & revisit, F.lit(REVISIT_PROFILE))),
        _field("X-Page-Id", F.col("page_id").cast("string")),
        _field("X-Refers-To-Page-Id", F.when(first, F.col("refers_to").cast("string"))),
        _field("WARC-Segment-Number", number),
        _field("WARC-Segment-Origin-ID", F.when(~first, F.col("record_id"))),
        _field("WARC-Segment-Total-Length", F.when(split & last, n.cast("string"))),
        _field("Content-Type", F.when(first, F.lit("application/http; msgtype=response"))),
        _field("Content-Length", size.cast("string")),
        F.lit(CRLF),
    ]
    return cuts.select(F.concat(*fields, F.col("part").cast("string")).alias("value"))


def write_warc(pages: DataFrame, path: str, compression: str = "gzip", **options) -> None:
    """Write the pages as WARC files below ``path``, one per task."""
    records(pages, **options).write.option("lineSep", END).option("compression", compression).text(path)


# ------------------------------------------------------------------ reading

def decode_chunked(data: bytes) -> bytes | None:
    """The body of a chunked HTTP message; None if the framing is broken."""
    out, at = [], 0
    while True:
        eol = data.find(b"\r\n", at)
        if eol < 0:
            return None
        try:
            size = int(data[at:eol].split(b";")[0], 16)
        except ValueError:
            return None
        at = eol + 2
        if size == 0:
            return b"".join(out)
        if at + size + 2 > len(data) or data[at + size:at + size + 2] != b"\r\n":
            return None
        out.append(data[at:at + size])
        at += size + 2


def decode_block(block: bytes) -> tuple[bytes | None, dict[bytes, bytes]]:
    """``(payload, HTTP fields)`` of a whole response block; the payload is None if it cannot be decoded."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return None, {}
    http = _fields(block[:end].split(b"\r\n")[1:])
    body = block[end + 4:]
    if http.get(b"transfer-encoding", b"").lower() == b"chunked":
        return decode_chunked(body), http
    return body, http


def _fields(lines: list[bytes]) -> dict[bytes, bytes]:
    out = {}
    for line in lines:
        name, _, value = line.partition(b":")
        out[name.strip().lower()] = value.strip()
    return out


def _checked(payload: bytes | None, header_digest: str | None) -> str:
    if payload is None:
        return "bad_chunk"
    if header_digest and b32encode(hashlib.sha1(payload).digest()).decode() != header_digest:
        return "digest_mismatch"
    return "ok"


def parse_records(stream: BinaryIO, segments: bool) -> Iterator[dict]:
    """One archive file's segments with their raw blocks, or else its other records, decoded."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        lines = []
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            lines.append(line)
        head = _fields(lines)
        text = lambda name: head[name].decode("utf-8", "replace") if name in head else None
        n = int(head.get(b"content-length", b"0"))
        block = stream.read(n)
        if len(block) == n and (b"warc-segment-number" in head) != segments or len(block) < n and segments:
            continue
        digest = text(b"warc-payload-digest")
        out = {
            "record_id": text(b"warc-record-id"), "type": text(b"warc-type"), "target_uri": text(b"warc-target-uri"),
            "page_id": text(b"x-page-id"), "refers_to": text(b"x-refers-to-page-id"),
            "header_digest": digest.removeprefix("sha1:") if digest else None, "origin": None, "segment": None, "total": None,
            "block": None, "payload": None, "payload_bytes": None, "status": "ok",
        }
        if len(block) < n:
            out["status"] = "truncated"
        elif b"warc-segment-number" in head:
            out["segment"] = int(head[b"warc-segment-number"])
            out["origin"] = text(b"warc-segment-origin-id") or out["record_id"]
            out["total"] = int(head[b"warc-segment-total-length"]) if b"warc-segment-total-length" in head else None
            out["block"] = block
        elif out["type"] == "response":
            out["payload"], _ = decode_block(block)
            out["status"] = _checked(out["payload"], out["header_digest"])
            out["payload_bytes"] = None if out["payload"] is None else len(out["payload"])
        elif out["type"] == "revisit":
            _, http = decode_block(block)
            size = http.get(b"content-length", b"")
            out["payload_bytes"] = int(size) if size.isdigit() else None
        yield out


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_ARROW = pa.schema([
    ("record_id", pa.string()), ("type", pa.string()), ("target_uri", pa.string()), ("page_id", pa.string()),
    ("refers_to", pa.string()), ("header_digest", pa.string()), ("origin", pa.string()), ("segment", pa.int32()),
    ("total", pa.int64()), ("block", pa.binary()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("status", pa.string()),
])


def _parse_files(segments: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for i in range(files.num_rows):
                data = files.column(0)[i].as_buffer()
                raw = pa.BufferReader(data)
                packed = data.size >= 2 and bytes(data[:2]) == b"\x1f\x8b"
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if packed else raw, 1 << 20)
                held, size = [], 0
                for row in parse_records(stream, segments):
                    held.append(row)
                    size += len(row["block"] or b"") + len(row["payload"] or b"") + 500
                    if size > _OUT_BYTES:
                        yield _batch(held, _ARROW)
                        held, size = [], 0
                if held:
                    yield _batch(held, _ARROW)

    return run


def join_segments(parts: list[tuple[int, bytes]], total: int | None) -> tuple[bytes, str]:
    """``(block, status)`` from segments in order of number."""
    block = b"".join(b for _, b in parts)
    if [n for n, _ in parts] != list(range(1, len(parts) + 1)) or total is None:
        return block, "missing_segment"
    return block, "ok" if len(block) == total else "length_mismatch"


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            block, status = join_segments([(p["segment"], p["block"]) for p in row.pop("parts")], row["total"])
            payload = None
            if status == "ok":
                payload, _ = decode_block(block)
                status = _checked(payload, row["header_digest"])
            yield _batch([row | {"segment": None, "block": None, "payload": payload, "status": status,
                                 "payload_bytes": None if payload is None else len(payload)}], _ARROW)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, type, target_uri, page_id, refers_to, header_digest, payload, payload_bytes, status``: one row per page.

    A revisit has no payload; its ``payload_bytes`` and ``header_digest`` are
    those of the payload it refers to.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    whole = files.mapInArrow(_parse_files(segments=False), RECORDS)
    segments = files.mapInArrow(_parse_files(segments=True), RECORDS)
    first = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    grouped = segments.groupBy("origin").agg(
        *[first(c) for c in ("record_id", "type", "target_uri", "page_id", "refers_to", "header_digest")],
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )
    rebuilt = grouped.mapInArrow(_reassemble, RECORDS)
    return whole.unionByName(rebuilt).drop("origin", "segment", "total", "block")
