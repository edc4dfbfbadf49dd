"""WARC archives: a writer with revisit records, and a splittable reader.

Each record is a gzip member of its own. A reading task gets a byte range of a file. It
looks for the gzip magic, and takes a candidate if what it decodes to starts like a
WARC record; then it decodes the whole member, beyond the end of its range if need be,
and goes on behind it. A task owns the records that start inside its range, so every
record is read once, wherever ranges are cut. It holds one record at a time.

(A candidate inside another member's compressed bytes would have to decode to a WARC
header. Compressed data does that only where it stores, uncompressed, an archive that
is itself gzipped; keep such payloads out of files read with ranges inside records.)

Writing: of payloads of at least ``MIN_REVISIT`` bytes that are equal, the one of the
smallest page id is a response and the others revisit it. Digests are folded per
payload with map-side combination and only ids and digests are joined with the folds,
so a payload that a third of all pages share is no hot group. A revisit record keeps
the response's HTTP headers, and with them the payload's length.

Files are written and read with pyarrow file systems inside tasks; their names hold
the attempt, and only files in the manifest, a table, count.

Reading takes records of any kind and writer: an absent header reads null, a record
without HTTP headers has its whole block as payload, a revisit has none. A digest is
checked where it is SHA-256 or SHA-1, else ``intact`` is null. A member that begins as a
record but can't be decoded to its end is a row of type ``damaged``, and
``check_counts`` fails where a file has not as many records as its manifest says.

Defined results: null html is an empty payload. Pages of one id and one payload are
alike: all are responses if one of them is. A null id never becomes the one referred
to while another page has an id. Without a url there is no target. Other columns are
not stored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm import common

MIN_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
BLOCK_BYTES = 1 << 18
DATE = "2000-01-01T00:00:00Z"
# Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

MANIFEST = "file string, bytes bigint, records bigint"
RECORDS = (
    "record_type string, record_id string, page_id bigint, refers_to bigint, url string, payload binary, "
    "payload_bytes bigint, payload_digest string, intact boolean, file string, start bigint"
)


def record_types(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``k``, ``url``, ``payload``, ``digest``, and ``refers_to`` for revisits."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    own = pages.select(F.col(key).alias("k"), F.col(url).alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    ids = own.filter(F.octet_length("payload") >= MIN_REVISIT).select("k", "digest")
    first = ids.groupBy("digest").agg(F.min("k").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    again = ids.join(first, "digest").filter(~F.col("k").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull())
    again = again.groupBy(F.col("k").alias("k2"), F.col("digest").alias("d2")).agg(F.first("refers_to").alias("refers_to"))
    return own.join(again, F.col("k").eqNullSafe(F.col("k2")) & (F.col("digest") == F.col("d2")), "left").drop("k2", "d2")


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, path: str, *, archive_bytes: int = ARCHIVE_BYTES, **columns) -> DataFrame:
    """Write ``pages`` as archives below ``path``; the manifest, a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name, k = f"{path}/part-{context.partitionId():05d}-{context.taskAttemptId()}", 0
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        row = next(rows, None)
        while row is not None:
            seen = [0, 0]

            def members() -> Iterator[bytes]:
                nonlocal row
                while row is not None and seen[0] < archive_bytes:
                    member = record(*row)
                    seen[0] += len(member)
                    seen[1] += 1
                    yield member
                    row = next(rows, None)

            file = f"{name}-{k:04d}.warc.gz"
            common.write_once(file, members())
            yield pa.RecordBatch.from_pydict({"file": [file], "bytes": [seen[0]], "records": [seen[1]]})
            k += 1

    typed = record_types(pages, **columns).select("k", "url", "payload", "digest", "refers_to")
    return common.written(typed.mapInArrow(run, MANIFEST), "manifest")


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _number(headers: dict[str, str], name: str) -> int | None:
    value = headers.get(name, "")
    return int(value) if value.isdecimal() else None


def _is_intact(payload: bytes, digest: str | None) -> bool | None:
    """Whether a payload has the digest ``algorithm:value``; null if that can't be told."""
    kind, _, value = (digest or "").partition(":")
    if kind.lower() == "sha256":
        return hashlib.sha256(payload).hexdigest() == value.lower()
    if kind.lower() == "sha1":
        own = hashlib.sha1(payload)
        return value.lower() == own.hexdigest() if len(value) == 40 else value.upper() == base64.b32encode(own.digest()).decode()
    return None


def parse(raw: bytes) -> dict:
    """A decoded member as a row of ``RECORDS``."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    h = _headers(head)
    length = _number(h, "content-length")
    block = rest.removesuffix(b"\r\n\r\n") if length is None else rest[:length]
    kind, digest = h.get("warc-type"), h.get("warc-payload-digest")
    http, body = {}, block
    if h.get("content-type", "").lower().startswith("application/http") or block.startswith(b"HTTP/"):
        first, _, body = block.partition(b"\r\n\r\n")
        http = _headers(first)
    row = {
        "record_type": kind, "record_id": h.get("warc-record-id"), "page_id": _number(h, "x-page-id"),
        "refers_to": _number(h, "x-refers-to-page-id"), "url": h.get("warc-target-uri"),
        "payload_digest": None if digest is None else digest.removeprefix("sha256:")}
    if kind == "revisit":  # the payload is elsewhere
        return row | {"payload": None, "payload_bytes": _number(http, "content-length"), "intact": True}
    return row | {"payload": body, "payload_bytes": len(body), "intact": _is_intact(body, digest)}


class _Bytes:
    """A file from ``at`` on, in blocks; forgets what is behind."""

    def __init__(self, file, at: int, size: int):
        self.file, self.size, self.at, self.held = file, size, at, b""

    def fill(self) -> bool:
        end = self.at + len(self.held)
        more = self.file.read_at(min(BLOCK_BYTES, self.size - end), end) if end < self.size else b""
        self.held += more
        return bool(more)

    def skip(self, n: int) -> None:
        self.at, self.held = self.at + n, self.held[n:]


def _member(src: _Bytes) -> tuple[bytes | None, int] | None:
    """The member that starts at ``src`` and its length, or None if it isn't a record; a
    record that ends too early or can't be decoded is (None, 0)."""
    unpack, out, fed, known = zlib.decompressobj(31), [], 0, False
    try:
        while not unpack.eof:
            if fed == len(src.held) and not src.fill():
                return (None, 0) if known else None
            part = src.held[fed:]
            fed = len(src.held)
            # A few bytes first: most candidates that are none end here.
            start = b"" if known else unpack.decompress(part, len(VERSION))
            if not known:
                out.append(start)
                if len(b"".join(out)) < len(VERSION) and not unpack.eof:
                    continue
                if not b"".join(out).startswith(VERSION):
                    return None
                known, part = True, unpack.unconsumed_tail
            out.append(unpack.decompress(part))
    except zlib.error:
        return (None, 0) if known else None
    return b"".join(out), fed - len(unpack.unused_data)


def records_in(file, size: int, start: int, end: int, damaged: list[int] | None = None) -> Iterator[tuple[int, bytes]]:
    """(position, decoded member) of the records that start in ``start:end``. ``damaged`` gets
    the positions of those that can't be decoded."""
    src = _Bytes(file, start, size)
    while src.at < end:
        found = src.held.find(MAGIC)
        if found < 0:
            src.skip(max(0, len(src.held) - len(MAGIC) + 1))
            if not src.fill():
                return
            continue
        src.skip(found)
        if src.at >= end:
            return
        member = _member(src)
        if member is None or member[0] is None:
            if member is not None and damaged is not None:
                damaged.append(src.at)
            src.skip(1)
            continue
        yield src.at, member[0]
        src.skip(member[1])


def read_archives(manifest: DataFrame, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``RECORDS`` of all files of a manifest (``file``, ``bytes``), read in ranges."""
    spark = manifest.sparkSession
    ranges = manifest.select("file", "bytes", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.greatest(F.col("bytes") - 1, F.lit(0).cast("bigint")), F.lit(range_bytes).cast("bigint"))).alias("start"))
    kind = spark.createDataFrame([], RECORDS).schema
    arrow = pa.schema([
        (f.name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[f.dataType.simpleString()]) for f in kind])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            for path, size, start in zip(*(c.to_pylist() for c in b.columns)):
                files, inside = common.file_system(path)
                damaged: list[int] = []
                with files.open_input_file(inside) as f:
                    for at, raw in records_in(f, size, start, start + range_bytes, damaged):
                        rows.append(parse(raw) | {"file": path, "start": at})
                        held += len(raw)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
                rows += [{"record_type": "damaged", "intact": False, "file": path, "start": at} for at in damaged]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return ranges.repartition(F.col("file"), F.col("start")).mapInArrow(run, kind)


def check_counts(records: DataFrame, manifest: DataFrame) -> None:
    """Fail, and name some files, where ``records`` has not as many whole records of a file as
    its manifest (``file``, ``records``) says."""
    found = records.filter(~F.col("record_type").eqNullSafe("damaged")).groupBy("file").agg(F.count("*").alias("found"))
    wrong = manifest.select("file", "records").join(found, "file", "left").filter(F.coalesce("found", F.lit(0)) != F.col("records"))
    some = wrong.orderBy("file").limit(10).collect()
    if some:
        raise RuntimeError("records are missing: " + ", ".join(f"{r['file']} has {r['found'] or 0} of {r['records']}" for r in some))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(common.table(spark, sf_dir, "pages"), common.shared_path(spark, "warc"))
    return read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH page AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
first AS (SELECT payload_digest, min(page_id) AS first_id FROM page WHERE payload_bytes >= {MIN_REVISIT} GROUP BY payload_digest)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM page LEFT JOIN first USING (payload_digest)"""
