"""Fill-in-middle transformation with memoised content-defined chunks.

A text is a row of units: a run of ASCII letters, or any other character. Two cuts
after a number of units drawn from the document's id part it into prefix, middle and
suffix. To find the cuts units must be counted, and much of a corpus repeats (licences,
headers, copies), so they are counted once per distinct chunk and worker:

1. A rolling hash of the last ``ROLL`` bytes ends a chunk where its top bits are
   zero, so equal passages fall into equal chunks wherever they stand. Chunks
   never split a character and are at most ``MAX_CHUNK`` bytes long.
2. A chunk's summary is its units, its characters, and whether it begins and ends with a
   letter. A dictionary from the chunk's bytes to the summary holds those of chunks seen:
   equal hashes count only with equal content. It is emptied at ``CACHE_BYTES``.
3. Neighbouring summaries combine: units add up, less one where a run of letters goes on
   over the border. Running sums of a document's chunks name the chunk in which a cut
   lies, and only that chunk is read for its place.

One scan, no shuffle. A task holds one Arrow batch, some megabytes of it at a time, and
the cache.

Defined results: a null text is an empty one, which is left plain. A null id draws as an
empty id. Repeated rows get the same cuts. Other columns go through unchanged.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.llm import common, words as W

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1"
PLAIN_FROM = 90  # a third draw (of 100) of this or more leaves the text plain
SPM_BELOW = 20  # a fourth draw (of 100) below this puts the suffix first
ROLL = 32
MEAN_BITS = 9
MAX_CHUNK = 4096
CACHE_BYTES = 32 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[0x80:0xC0] = True  # bytes after the first of a character
_GEAR = W.mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin; each row with a byte begins one. ``offsets`` as of ``W.bytes_of``."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    rolled, have = _GEAR[data], 1
    while have < ROLL:  # the hash of twice as many bytes: h(i) + h(i - have) * 2**have
        rolled[have:] = rolled[have:] + (rolled[:-have] << np.uint32(have))
        have *= 2
    at = np.flatnonzero(rolled >> np.uint32(32 - MEAN_BITS) == 0) + 1
    rows = np.unique(offsets[:-1][offsets[:-1] < offsets[1:]])
    row = rows[np.searchsorted(rows, at, side="right") - 1]
    at = at[(at - row >= ROLL) & (at < len(data))]  # no hash looks into the text before
    at = np.union1d(at[~_INSIDE[data[at]]], rows)
    length = np.diff(np.append(at, len(data)))
    long = np.flatnonzero(length > MAX_CHUNK)
    forced = [np.arange(at[i] + MAX_CHUNK, at[i] + length[i], MAX_CHUNK) for i in long.tolist()]
    if forced:
        more = np.concatenate(forced)
        for _ in range(3):
            more = more - _INSIDE[data[more]]
        at = np.union1d(at, more)
    return at


def _unit_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Marks first bytes of units, where a unit ends with its chunk."""
    letter = _LETTER[data]
    goes_on = np.zeros(len(data), dtype=bool)
    goes_on[1:] = letter[1:] & letter[:-1]
    goes_on[starts] = False
    return ~goes_on & ~_INSIDE[data]


class Summaries:
    """(units, characters, begins with a letter, ends with a letter) of chunks by content."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.size, self.known, self.found = limit, 0, {}, 0

    def _count(self, chunks: list[bytes]) -> None:
        data = np.frombuffer(b"".join(chunks), dtype=np.uint8)
        ends = np.cumsum([len(c) for c in chunks])
        starts = np.concatenate([[0], ends[:-1]])
        units = np.add.reduceat(_unit_starts(data, starts), starts, dtype=np.int64)
        chars = np.add.reduceat(~_INSIDE[data], starts, dtype=np.int64)
        rows = zip(units.tolist(), chars.tolist(), _LETTER[data[starts]].tolist(), _LETTER[data[ends - 1]].tolist())
        self.known.update(zip(chunks, rows))

    def __call__(self, chunks: list[bytes]) -> np.ndarray:
        """A row of four numbers per chunk."""
        new = [c for c in dict.fromkeys(chunks) if c not in self.known]
        self.found += len(chunks) - len(new)
        size = sum(map(len, new))
        if self.size + size > self.limit:
            self.known, self.size = {}, 0
            new = list(dict.fromkeys(chunks))
            size = sum(map(len, new))
        if new:
            self._count(new)
            self.size += size
        return np.array([self.known[c] for c in chunks], dtype=np.int64).reshape(-1, 4)


class Texts:
    """Units of some rows, from summaries of their chunks."""

    def __init__(self, column: pa.Array, summaries: Summaries):
        self.data, self.offsets = W.bytes_of(column)
        self.raw = self.data.tobytes()
        self.starts = chunk_starts(self.data, self.offsets)
        self.ends = np.append(self.starts[1:], len(self.data))
        s = summaries([self.raw[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist())])
        row_start = np.isin(self.starts, self.offsets)
        self.joined = np.zeros(len(s), dtype=np.int64)
        self.joined[1:] = s[1:, 2] & s[:-1, 3] & ~row_start[1:]
        self.units = np.concatenate([[0], np.cumsum(s[:, 0] - self.joined)])
        self.chars = np.concatenate([[0], np.cumsum(s[:, 1])])
        self.first = np.searchsorted(self.starts, self.offsets)  # first chunk of each row
        self.n = np.diff(self.units[self.first])

    def text(self, row: int) -> bytes:
        return self.raw[self.offsets[row]: self.offsets[row + 1]]

    def cut(self, row: int, units: int) -> tuple[int, int]:
        """(bytes, characters) of the first ``units`` units of a row."""
        begin, end = int(self.first[row]), int(self.first[row + 1])
        if units == self.n[row]:
            return int(self.offsets[row + 1] - self.offsets[row]), int(self.chars[end] - self.chars[begin])
        wanted = int(self.units[begin]) + units + 1  # the cut lies before this unit
        c = int(np.searchsorted(self.units, wanted)) - 1
        data = self.data[self.starts[c]: self.ends[c]]
        at = int(np.flatnonzero(_unit_starts(data, np.zeros(1, dtype=np.int64)))[wanted - int(self.units[c]) - 1 + int(self.joined[c])])
        chars = int(self.chars[c] - self.chars[begin]) + int(np.count_nonzero(~_INSIDE[data[:at]]))
        return int(self.starts[c] - self.offsets[row]) + at, chars


@functools.cache
def _shared_summaries() -> Summaries:
    return Summaries()  # one per Python worker, which Spark uses for many tasks


_MADE = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"
_FIELDS = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]


def transformed(digests: list[str], column: pa.Array, plain_from: int, spm_below: int, summaries: Summaries) -> Iterator[tuple]:
    """(n, form, prefix characters, middle characters, output bytes) of each row."""
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    for first, upto in W.chunks(column):
        texts = Texts(column.slice(first, upto - first), summaries)
        for row in range(upto - first):
            text, n = texts.text(row), int(texts.n[row])
            h = [int(digests[first + row][i: i + 8], 16) for i in (0, 8, 16, 24)]
            if not text or h[2] % 100 >= plain_from or any(mark in text for mark in marks):
                yield n, "plain", None, None, text
                continue
            (a, before), (b, upto_middle) = (texts.cut(row, k) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
            if h[3] % 100 < spm_below:
                yield n, "spm", before, upto_middle - before, b"".join((s, text[b:], p, text[:a], m, text[a:b]))
            else:
                yield n, "psm", before, upto_middle - before, b"".join((p, text[:a], s, text[b:], m, text[a:b]))


def fill_in_middle(
    docs: DataFrame, name: str, *, key: str = "doc_id", text: str = "text", seed: str = SEED,
    plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW,
) -> DataFrame:
    """``docs`` with a struct ``name``: units ``n``, ``form`` (plain, psm or spm),
    characters of prefix and middle (null if plain), and the ``output`` text."""

    @F.arrow_udf(_MADE)
    def made(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for digests, texts in parts:
            rows = list(transformed(digests.to_pylist(), texts, plain_from, spm_below, _shared_summaries()))
            columns = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_FIELDS[:4])]
            columns.append(pa.array([r[4] for r in rows], pa.binary()).cast(pa.string()))
            yield pa.StructArray.from_arrays(columns, fields=[pa.field(*f) for f in _FIELDS])

    draws = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return docs.withColumn(name, made.asNondeterministic()(draws, F.col(text)))  # never evaluated twice for one row


def restored(output: Column, form: Column) -> Column:
    """The text, from output and form alone. A text with a mark in it is left plain, and no
    mark begins or ends inside another, so the three marks are those that were set."""
    parts = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .otherwise(F.concat(parts[2], parts[3], parts[1])))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    made = F.col("made")
    return fill_in_middle(docs, "made").select(
        "doc_id", made["n"].alias("n"), made["form"].alias("form"), made["prefix_chars"].alias("prefix_chars"),
        made["middle_chars"].alias("middle_chars"), F.sha2(made["output"], 256).alias("output_sha256"),
        F.sha2(restored(made["output"], made["form"]), 256).alias("restored_sha256"))


SQL = rf"""
WITH doc AS (
    SELECT doc_id, coalesce(text, '') AS x, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
draw AS (
    SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
        ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM doc),
cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN x = '' OR contains(x, '{PREFIX}') OR contains(x, '{SUFFIX}') OR contains(x, '{MIDDLE}') OR h3 % 100 >= {PLAIN_FROM} THEN 'plain'
            WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM draw),
part AS (
    SELECT *, array_to_string(list_slice(u, 1, a), '') AS p, array_to_string(list_slice(u, a + 1, b), '') AS m,
        array_to_string(list_slice(u, b + 1, n), '') AS s FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
        ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN x ELSE p || m || s END) AS restored_sha256
FROM part"""
