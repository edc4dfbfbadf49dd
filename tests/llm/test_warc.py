"""Round trips through archives, with ranges cut at every place."""

import base64
import gzip
import hashlib
import io
import random

import pytest

from lakeops.llm import warc as A


class Source(io.BytesIO):
    def read_at(self, n, at):
        return self.getvalue()[at: at + n]


@pytest.mark.parametrize("step", [1, 7, 64, 1000, 10**6])
def test_every_record_once_for_any_ranges(step, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_BYTES", 37)
    rnd = random.Random(3)
    payloads = [b"", b"x", rnd.randbytes(700), b"\x1f\x8b\x08" * 50, b"WARC/1.0 " * 30, rnd.randbytes(20)]
    members = [A.record(i, "u", p, "0" * 64, None) for i, p in enumerate(payloads)]
    raw = b"".join(members)
    starts = [sum(map(len, members[:i])) for i in range(len(members))]
    got = [r for a in range(0, len(raw), step) for r in A.records_in(Source(raw), len(raw), a, a + step)]
    assert [at for at, _ in got] == starts
    assert [A.parse(m)["payload"] for _, m in got] == payloads
    assert gzip.decompress(raw) == b"".join(m for _, m in got)


def test_foreign_members_and_torn_files():
    good = A.record(1, None, b"page", "0" * 64, None)
    raw = b"junk\x1f\x8b\x08junk" + gzip.compress(b"not a record") + good + A.record(2, "u", b"y" * 500, "0" * 64, None)[:-20]
    got = list(A.records_in(Source(raw), len(raw), 0, len(raw)))
    assert [A.parse(m)["page_id"] for _, m in got] == [1]


def frames(spark):
    long = "é" * 300_000
    rows = [
        (1, "http://a", "p" * 99, 0), (2, "http://b", "p" * 99, 0), (3, None, "q" * 100, 0), (4, "http://c\r\nX-Page-ID: 9", "q" * 100, 0),
        (5, "u", None, 0), (6, "u", "", 0), (7, "u", long, 0), (8, "u", long, 0), (8, "u", long, 0), (None, "u", "q" * 100, 0),
        (9, "u", "é" * 50, 0), (9, "u", "other " * 30, 0), (10, "u", "é" * 50, 0)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int")


@pytest.mark.parametrize("archive, ranges", [(1, 50), (400, 64), (1 << 30, 1 << 20)])
def test_round_trip(spark, tmp_path, archive, ranges):
    pages = frames(spark).repartition(3)
    manifest = A.write_archives(pages, f"file://{tmp_path}/w", archive_bytes=archive)
    got = A.read_archives(manifest, range_bytes=ranges).collect()
    key = lambda r: str(r)
    assert all(r.intact for r in got)
    want = {1: None, 2: None, 3: None, 4: 3, 5: None, 6: None, 7: None, 8: 7, None: 3, 9: None, 10: 9}
    assert sorted(((r.page_id, r.refers_to, r.record_type) for r in got), key=key) == sorted(
        ((p.page_id, want[p.page_id], "response" if want[p.page_id] is None else "revisit") for p in pages.collect()), key=key)
    html = sorted((p.html or "").encode() for p in pages.collect() if want[p.page_id] is None)
    assert sorted(bytes(r.payload) for r in got if r.payload is not None) == html
    assert {r.page_id: r.payload_bytes for r in got}[8] == 600_000
    assert {r.page_id: r.url for r in got}[3] is None


def test_empty_table(spark, tmp_path):
    manifest = A.write_archives(frames(spark).limit(0), f"file://{tmp_path}/w")
    assert A.read_archives(manifest).collect() == []


def member(*lines, block=b"", length=True):
    head = ["WARC/1.1", *lines, *([f"Content-Length: {len(block)}"] if length else [])]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def test_records_of_other_writers(spark, tmp_path):
    page = b"<html>\xc3\xa9</html>"
    sha1 = base64.b32encode(hashlib.sha1(page).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    made = [
        member("WARC-Type: warcinfo", "WARC-Record-ID: <urn:1>", "Content-Type: application/warc-fields", block=b"software: x\r\n"),
        member("WARC-Type: request", "Content-Type: application/http; msgtype=request", block=b"GET / HTTP/1.1\r\nHost: h\r\n\r\nbody"),
        member("WARC-Type: response", "WARC-Target-URI: http://a", f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: application/http", block=http + page),
        member("WARC-Type: resource", "Content-Type: text/html", f"WARC-Payload-Digest: sha256:{hashlib.sha256(page).hexdigest()}", block=page),
        member("WARC-Type: metadata", block=b"fetchTimeMs: 3"), member("WARC-Type: conversion", "Content-Type: text/plain", block=b"plain"),
        member("WARC-Type: revisit", "WARC-Refers-To: <urn:2>"), member("WARC-Type: revisit", "Content-Type: application/http", block=http),
        member("WARC-Type: response", "WARC-Payload-Digest: sha1:" + "A" * 32, "X-Page-ID: none", block=page, length=False), member(block=b"no type")]
    raw = b"".join(made)
    (tmp_path / "x.warc.gz").write_bytes(raw[:-30])
    manifest = spark.createDataFrame([(f"file://{tmp_path}/x.warc.gz", len(raw) - 30, 10)], A.MANIFEST)
    records = A.read_archives(manifest, range_bytes=100)
    got = [(r.record_type, None if r.payload is None else bytes(r.payload), r.payload_bytes, r.intact) for r in records.orderBy("start").collect()]
    assert got == [
        ("warcinfo", b"software: x\r\n", 13, None), ("request", b"body", 4, None), ("response", page, len(page), True), ("resource", page, len(page), True),
        ("metadata", b"fetchTimeMs: 3", 14, None), ("conversion", b"plain", 5, None), ("revisit", None, None, True), ("revisit", None, None, True),
        ("response", page, len(page), False), ("damaged", None, None, False)]
    with pytest.raises(RuntimeError, match="x.warc.gz has 9 of 10"):
        A.check_counts(records, manifest)


def test_counts_of_whole_files(spark, tmp_path):
    manifest = A.write_archives(frames(spark).repartition(2), f"file://{tmp_path}/w")
    A.check_counts(A.read_archives(manifest), manifest)
