"""Benchmark decontamination with an Aho-Corasick automaton.

Questions and answers are normalised (A-Z lowered, words of letters, digits and all
non-ASCII characters, one space between) and cut into windows of 13 words; an item of
fewer words is one window. All windows form one automaton, and every text is scanned
once. A word of a text inside any occurrence of a window is hit; hits are mapped back
to character positions of the original text.

The automaton goes to every task, so its size is bounded: benchmarks are cut into
blocks of at most ``block_bytes`` of window text, one scan each, and the next scan
adds to what the last one found. The driver holds one block at a time.

Defined results: a null or empty text has no words and no hits. An item without words
has no window. Items with equal texts or ids, and repeated documents, are each judged
as they stand. Item ids are compared and listed as strings; a null id reads ``null``.
Documents may have any columns; only the text column and the added one are touched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.llm import common

WINDOW = 13
BLOCK_BYTES = 32 << 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

HITS = (
    "struct<n_words: bigint, hits: array<struct<first: bigint, last: bigint, start: bigint, end: bigint>>, "
    "items: array<string>>"
)
_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("hits", pa.list_(pa.struct([
        ("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
    ]))),
    ("items", pa.list_(pa.string())),
])


def _normaliser() -> bytes:
    lowered = bytes(range(256)).lower()
    return bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in lowered)


_READS = _normaliser()


def normal_words(text: str) -> list[bytes]:
    """Words of the normalised text, as UTF-8."""
    return text.encode().translate(_READS).split()


def item_windows(text: str | None, width: int = WINDOW) -> list[tuple[bytes, int]]:
    """The windows of an item and how many words each has."""
    words = normal_words(text or "")
    if not words:
        return []
    last = max(0, len(words) - width)
    return [(b" ".join(words[i: i + width]), min(width, len(words))) for i in range(last + 1)]


def _padded(words: bytes) -> str:
    # One character per byte. The blanks around keep matches on word boundaries.
    return (b" " + words + b" ").decode("latin-1")


def blocks(items: DataFrame, item_id: str, text: str, width: int, limit: int) -> Iterator[dict[bytes, tuple[int, list[str]]]]:
    """Windows with their number of words and the items that contain them."""
    block: dict[bytes, tuple[int, list[str]]] = {}
    size = 0
    for row in items.select(F.col(item_id).cast("string"), F.col(text)).toLocalIterator():
        name = "null" if row[0] is None else row[0]
        for window, n in item_windows(row[1], width):
            if size > limit:
                yield block
                block, size = {}, 0
            names = block.setdefault(window, (n, []))[1]
            if name not in names:
                names.append(name)
                size += len(window) + len(name)
    yield block


def _automaton(block: dict[bytes, tuple[int, list[str]]]):
    found = ahocorasick.Automaton()
    for window, value in block.items():
        found.add_word(_padded(window), value)
    if block:
        found.make_automaton()
    return found


def _positions(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Character spans of word ranges, in the original text."""
    spans = [m.span() for m in WORD.finditer(text)]
    return [{"first": a, "last": b, "start": spans[a][0], "end": spans[b][1]} for a, b in ranges]


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scan_text(text: str | None, automaton, before: dict | None = None) -> dict:
    """Hits of one text: merged word ranges (both ends included) with character spans."""
    words = normal_words(text or "")
    ranges: list[tuple[int, int]] = []
    items: set[str] = set()
    if words and len(automaton):
        normal = _padded(b" ".join(words))
        matches = list(automaton.iter(normal))
        if matches:
            blanks = np.cumsum(np.frombuffer(normal.encode("latin-1"), dtype=np.uint8) == 0x20)
            for end, (n, names) in matches:
                last = int(blanks[end]) - 2
                ranges.append((last - n + 1, last))
                items.update(names)
    if before:
        ranges += [(h["first"], h["last"]) for h in before["hits"]]
        items.update(before["items"])
    return {"n_words": len(words), "hits": _positions(text, _merged(ranges)) if ranges else [], "items": sorted(items)}


def _scanner(block, chained: bool):
    cell: list = []

    def automaton():
        if not cell:  # once per Python worker and scan
            cell.append(_automaton(block.value))
        return cell[0]

    if chained:
        @F.arrow_udf(HITS)
        def scan(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            a = automaton()
            for texts, before in parts:
                yield pa.array((scan_text(t.as_py(), a, b.as_py()) for t, b in zip(texts, before)), _ARROW)
    else:
        @F.arrow_udf(HITS)
        def scan(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            a = automaton()
            for texts in parts:
                yield pa.array((scan_text(t.as_py(), a) for t in texts), _ARROW)

    return scan.asNondeterministic()  # never evaluated twice for one row


def with_hits(
    docs: DataFrame, items: DataFrame, name: str, *, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a column ``name`` (``HITS``): words, merged hits, and the items found."""
    spark = docs.sparkSession
    out = None
    for block in blocks(items, item_id, item_text, window, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        if out is None:
            out = docs.withColumn(name, _scanner(shared, False)(F.col(text)))
        else:
            # One automaton at a time in a worker: what was found so far is a table.
            out = common.written(out, "hits")
            out = out.withColumn(name, _scanner(shared, True)(F.col(text), F.col(name)))
    return out


def n_hit(hits: Column) -> Column:
    return F.aggregate(hits["hits"], F.lit(0).cast("bigint"), lambda n, h: n + h["last"] - h["first"] + 1)


def contaminated(hits: Column) -> Column:
    """One word in twenty or more is hit."""
    n = n_hit(hits)
    return (n > 0) & (20 * n >= hits["n_words"])


def without_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` less the contaminated ones, columns unchanged."""
    name = common.fresh(docs.columns, "hits")
    return with_hits(docs, items, name, **options).filter(~contaminated(F.col(name))).drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = with_hits(docs, common.table(spark, sf_dir, "benchmark"), "hits").select("doc_id", "hits")
    h = F.col("hits")
    return hits.select(
        "doc_id",
        h["n_words"].alias("n_words"),
        n_hit(h).alias("n_hit"),
        F.size(h["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(h["items"], ","), 256).alias("items_sha256"),
        contaminated(h).alias("contaminated"),
    )


_WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH item AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
win AS (
    SELECT DISTINCT item_id::VARCHAR AS item_id, least(len(w), {WINDOW}) AS n,
           array_to_string(list_slice(w, i, i + {WINDOW} - 1), ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
pos AS (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS (
    SELECT doc_id, i, win.n, item_id
    FROM (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s FROM pos) p JOIN win USING (n, s)),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""
