"""WARC: exact round trip of payloads, broken archives, edge rows."""

import base64
import gzip
import hashlib
import io
from collections import Counter

from pyspark.sql import functions as F

from ferry.llm import warc
from tests.conftest import SF


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def round_trip(spark, pages, path, **options):
    warc.write_warc(pages, path, **options)
    return warc.read_warc(spark, path)


def test_payloads_come_back_exactly(spark, tmp):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    for k, options in enumerate(({"segment_bytes": 700, "chunk_bytes": 64}, {"compression": "none"}, {})):
        back = round_trip(spark, pages, f"{tmp}/w{k}", **options).collect()
        first = {p: int(i) for i, p in sorted(((i, p) for i, p in want.items()), reverse=True)}
        assert len(back) == len(want)
        for r in back:
            page, payload = int(r["page_id"]), want[int(r["page_id"])]
            assert r["status"] == "ok" and r["payload_bytes"] == len(payload) and r["header_digest"] == digest(payload)
            if first[payload] == page:
                assert r["type"] == "response" and bytes(r["payload"]) == payload and r["refers_to"] is None
            else:
                assert r["type"] == "revisit" and r["payload"] is None and int(r["refers_to"]) == first[payload]


def test_edge_rows_and_clashing_columns(spark, tmp):
    long_text = "<p>\u00e9</p>\r\n\r\nWARC/1.1\r\n" * 40_000
    rows = [(5, "u5", None), (4, None, ""), (7, "http://x/ \r\nEvil: 1", "a"), (7, "http://x/", "a"), (9, "u", "a"), (None, "u", "a"), (None, "u", "only"),
            (None, "u", "only"), (10, "u", long_text), (11, "u", long_text), (12, "u", "0\r\n\r\n"), (13, "u", "\r\n"), (14, "u", "x" * 16384)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("digest", F.lit("x"))
    back = round_trip(spark, pages, f"{tmp}/w", segment_bytes=5000, chunk_bytes=999).collect()
    got = Counter((r["page_id"], r["type"], r["refers_to"], r["payload_bytes"], r["header_digest"], r["status"]) for r in back)
    line = lambda i, t, kind="response", of=None: (i, kind, of, len(t.encode()), digest(t.encode()), "ok")
    assert got == Counter([
        line("4", ""), line("5", "", "revisit", "4"), line("7", "a"), line("7", "a"), line("9", "a", "revisit", "7"), line(None, "a", "revisit", "7"),
        line(None, "only"), line(None, "only"), line("10", long_text), line("11", long_text, "revisit", "10"), line("12", "0\r\n\r\n"),
        line("13", "\r\n"), line("14", "x" * 16384),
    ])
    assert all(bytes(r["payload"]) == long_text.encode() for r in back if r["page_id"] == "10")
    assert round_trip(spark, pages.limit(0), f"{tmp}/none").count() == 0
    only_long = warc.write_warc(pages, f"{tmp}/m", min_bytes=2) or warc.read_warc(spark, f"{tmp}/m").filter("type = 'revisit'").count()
    assert only_long == 1 and {r["type"] for r in back} == {"response", "revisit"}


def record(kind, block, **fields):
    head = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def segments(origin, block, cut, total=None):
    out = []
    for i in range(0, len(block), cut):
        fields = {"WARC_Record_ID": origin if i == 0 else f"<{origin}-{i}>", "X_Page_Id": 1, "WARC_Segment_Number": i // cut + 1}
        if i:
            fields["WARC_Segment_Origin_ID"] = origin
        if i + cut >= len(block):
            fields["WARC_Segment_Total_Length"] = len(block) if total is None else total
        out.append(record("response" if i == 0 else "continuation", block[i:i + cut], **fields))
    return out


def test_foreign_and_broken_archives(spark, tmp):
    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked\r\n\r\n"
    good = http + b"5;ext=1\r\nhello\r\nA\r\n 123456789\r\n0\r\n\r\n"
    parts = {
        "whole": [record("response", good, WARC_Record_ID="whole"), record("warcinfo", b"software: x", WARC_Record_ID="info")],
        "plain": [record("response", b"HTTP/1.1 200 OK\r\n\r\nplain", WARC_Record_ID="plain")],
        "digest": [record("response", good, WARC_Record_ID="digest", WARC_Payload_Digest="sha1:AAAA")],
        "chunk": [record("response", http + b"5\r\nhel", WARC_Record_ID="chunk")],
        "seg": segments("seg", good, 7)[::-1],
        "gap": segments("gap", good, 7)[:2] + segments("gap", good, 7)[3:],
        "open": segments("open", good, 7)[:-1],
        "length": segments("length", good, 7, total=3),
        "cut": [record("response", good, WARC_Record_ID="cut")[:-20]],
    }
    import os

    os.makedirs(f"{tmp}/w")
    for name, records in parts.items():
        with open(f"{tmp}/w/{name}.warc.gz", "wb") as f:
            f.writelines(gzip.compress(r) for r in records)  # a gzip member per record, as is usual
    got = {r["record_id"]: (r["status"], r["payload"] and bytes(r["payload"])) for r in warc.read_warc(spark, f"{tmp}/w").collect()}
    body = b"hello 123456789"
    assert got == {
        "whole": ("ok", body), "info": ("ok", None), "plain": ("ok", b"plain"), "digest": ("digest_mismatch", body), "chunk": ("bad_chunk", None),
        "seg": ("ok", body), "gap": ("missing_segment", None), "open": ("missing_segment", None), "length": ("length_mismatch", None), "cut": ("truncated", None),
    }


def test_segments_of_one_file_are_parsed_apart():
    data = b"".join(segments("s", b"x" * 20, 8)) + record("response", b"HTTP/1.1 200 OK\r\n\r\nq", WARC_Record_ID="r")
    assert [r["segment"] for r in warc.parse_records(io.BufferedReader(io.BytesIO(data)), True)] == [1, 2, 3]
    assert [r["payload"] for r in warc.parse_records(io.BufferedReader(io.BytesIO(data)), False)] == [b"q"]
