"""Packing of documents into training sequences by order-preserving dynamic programming.

The documents of a partition form one stream of tokens. Windows of at most
``max_tokens`` cover it in order. A window may end after a document (free), after a
sentence (``sentence_penalty``) or, where a sentence runs on for more than
``free_gap`` tokens, at every ``free_gap``-th token of it (``free_penalty``). The cost
of a window is its padding plus the penalty of its end. With p(j) the position of cut
j and f(j) the least cost up to it,

    f(j) = penalty(j) + max_tokens - p(j) + min { f(i) + p(i) : p(j) - p(i) <= max_tokens },

a minimum over a sliding range, kept in a monotone queue: linear time. A window whose
length is a power of two needs no padding, which is settled after the cuts are made.

A task holds one stretch of the stream (``stretch`` windows): it commits the windows of
a stretch up to the cut of least cost that leaves at most one window's tokens, which open
the next stretch. At the end of a partition they stay open. Pieces are written as a table, and the open windows of ``TAILS``
neighbouring partitions, which hold at most ``TAILS`` windows of ids, are packed again as
one stream. So one window in a group of partitions is short, not one in each. Only
those open windows are shuffled.

Defined results: a null or empty text is its end token alone. Repeated rows are packed
each. Sequence ids are the partition number times 2**32 plus a running number, those of
packed tails 2**62 plus the same of the group; the written table settles them.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeops.llm import common, tokens

MAX_TOKENS = 4096
SENTENCE_PENALTY = 32
FREE_PENALTY = 128
FREE_GAP = 256
STRETCH = 64
TAILS = 256
_TAIL_IDS = 1 << 62

PIECES = T.StructType([
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("padded_length", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])


def least_cost_cuts(positions: list[int], penalties: list[int], limit: int, open_end: bool = False) -> list[int]:
    """Indexes of the chosen cuts. ``positions`` ascend from the first cut (the start of
    the stretch) to the last (its end), no two neighbours further apart than ``limit``.
    With ``open_end`` the stretch goes on: at most ``limit`` tokens behind the last chosen
    cut, possibly the first of all, stay open and cost nothing yet."""
    n = len(positions)
    cost, back = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque([(positions[0], 0)])  # (f(i) + p(i), i), ascending
    for j in range(1, n):
        p = positions[j]
        while p - positions[queue[0][1]] > limit:
            queue.popleft()
        best, back[j] = queue[0]
        cost[j] = penalties[j] + limit - p + best
        key = cost[j] + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], n - 1
    if open_end:
        j = min((i for i in range(n) if positions[-1] - positions[i] <= limit), key=lambda i: (cost[i], -i))
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def candidate_cuts(stops: np.ndarray, doc_ends: np.ndarray, total: int, gap: int, sentence: int, free: int) -> tuple[list[int], list[int]]:
    """Positions at which a window may end, with penalties; 0 and ``total`` included."""
    at = np.union1d(np.flatnonzero(stops) + 1, np.append(doc_ends, [0, total]))
    long = np.flatnonzero(np.diff(at) > gap)
    more = [np.arange(at[i] + gap, at[i + 1], gap) for i in long.tolist()]
    forced = np.concatenate(more) if more else np.zeros(0, dtype=at.dtype)
    every = np.union1d(at, forced)
    penalty = np.full(len(every), sentence)
    penalty[np.isin(every, forced)] = free
    penalty[np.isin(every, doc_ends)] = 0
    return every.tolist(), penalty.tolist()


def padded_length(length: int, limit: int) -> int:
    return length if length & (length - 1) == 0 else limit


class _Packer:
    """The stream of one partition. ``emit`` gets (row key, start, doc tokens, sequence, offset, ids)."""

    def __init__(self, limit: int, stretch: int, sentence: int, free: int, gap: int):
        self.limit, self.stretch, self.costs = limit, stretch * limit, (gap, sentence, free)
        self.docs: deque[tuple[object, int, int, np.ndarray, np.ndarray]] = deque()
        self.held = self.sequence = 0

    def add(self, key, ids: np.ndarray, stops: np.ndarray, start: int = 0, total: int | None = None) -> Iterator[tuple]:
        """``ids`` from place ``start`` on of a document of ``total`` ids (default: all of it)."""
        total, done = len(ids) if total is None else total, 0
        while done < len(ids):
            # a very long document enters in parts, so a stretch stays bounded
            part = slice(done, done + self.stretch)
            self.docs.append((key, start + done, total, ids[part], stops[part]))
            self.held += len(ids[part])
            done += len(ids[part])
            if self.held >= self.stretch:
                yield from self.pack(False)

    def pack(self, final: bool) -> Iterator[tuple]:
        """Windows of what is held; unless ``final``, the last one stays in ``docs``."""
        if not self.held:
            return
        lengths = np.array([len(d[3]) for d in self.docs])
        ends = np.cumsum(lengths)
        whole = np.array([d[1] + len(d[3]) == d[2] for d in self.docs])
        positions, penalties = candidate_cuts(
            np.concatenate([d[4] for d in self.docs]), ends[whole], self.held, *self.costs)
        cuts = [positions[j] for j in least_cost_cuts(positions, penalties, self.limit, not final)]
        done = 0
        for cut in cuts:
            offset = 0
            while done < cut:
                key, start, total, ids, stops = self.docs.popleft()
                take = min(len(ids), cut - done)
                if take:
                    yield key, start, total, self.sequence, offset, ids[:take]
                if take < len(ids):
                    self.docs.appendleft((key, start + take, total, ids[take:], stops[take:]))
                done, offset = done + take, offset + take
            self.sequence += 1
        self.held -= done


def pack(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str | None = None,
    max_tokens: int = MAX_TOKENS, sentence_penalty: int = SENTENCE_PENALTY, free_penalty: int = FREE_PENALTY,
    free_gap: int = FREE_GAP, stretch: int = STRETCH, end_token: int = tokens.END_OF_TEXT,
) -> DataFrame:
    """One row per piece: ``key``, then ``PIECES``; ``ids`` are little-endian unsigned
    32-bit numbers. Each document's ids are followed by ``end_token``."""
    path = vocabulary or tokens.vocabulary_path()
    names = [f.name for f in PIECES.fields]
    out = T.StructType([docs.schema[key], *PIECES.fields])
    part, tail, stops_ = (common.fresh(out.names, c) for c in ("part", "tail", "stops"))
    wide = out.add(part, T.LongType()).add(tail, T.BooleanType()).add(stops_, T.BinaryType())
    out = T.StructType([docs.schema[key], *PIECES.fields])
    new = lambda: _Packer(max_tokens, stretch, sentence_penalty, free_penalty, free_gap)

    def columns(rows: list[tuple], base: int, key_type: pa.DataType) -> list[pa.Array]:
        lengths = {r[3]: r[4] + len(r[5]) for r in rows}  # whole windows, pieces in order
        return [
            pa.array([r[0] for r in rows], key_type), pa.array([r[1] for r in rows], pa.int64()), pa.array([len(r[5]) for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.int64()), pa.array([base + r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64()),
            pa.array([padded_length(lengths[r[3]], max_tokens) for r in rows], pa.int64()),
            pa.array([r[5].astype("<u4").tobytes() for r in rows], pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        packer, rows, key_type = new(), [], None

        def batch(arrays: list[pa.Array], stops: list[bytes] | None = None) -> pa.RecordBatch:
            n = len(arrays[0])
            more = [pa.array([number] * n, pa.int64()), pa.array([stops is not None] * n), pa.array(stops or [None] * n, pa.binary())]
            return pa.RecordBatch.from_arrays([*arrays, *more], wide.names)

        for b in batches:
            keys, key_type = b.column(0), b.schema.field(0).type
            for row, ids, stops in tokens.token_rows(b.column(1), path, end_token):
                rows.extend(packer.add(keys[row].as_py(), ids, stops))  # whole windows
                if len(rows) > 2000:
                    yield batch(columns(rows, number << 32, key_type))
                    rows = []
        rows.extend(packer.pack(False))
        if rows:
            yield batch(columns(rows, number << 32, key_type))
        if packer.docs:  # the open window: its pieces in order, to be packed again
            rows = [(k, start, total, 0, place, ids) for place, (k, start, total, ids, _) in enumerate(packer.docs)]
            yield batch(columns(rows, 0, key_type), [np.packbits(d[4]).tobytes() for d in packer.docs])

    def again(group: pa.Table) -> pa.Table:
        group, packer, rows = group.sort_by([(part, "ascending"), ("offset", "ascending")]), new(), []
        key_type = group.schema.field(key).type
        for k, start, total, raw, stops in zip(*(group[c].to_pylist() for c in (key, "start", "doc_tokens", "ids", stops_))):
            ids = np.frombuffer(raw, dtype="<u4")
            rows.extend(packer.add(k, ids, np.unpackbits(np.frombuffer(stops, dtype=np.uint8), count=len(ids)).astype(bool), start, total))
        rows.extend(packer.pack(True))
        base = _TAIL_IDS + (group[part][0].as_py() // TAILS << 32)
        return pa.Table.from_arrays(columns(rows, base, key_type), [key, *names])

    table = common.written(docs.select(F.col(key), F.col(text)).mapInArrow(run, wide), "windows")
    tails = table.filter(F.col(tail)).groupBy(F.floor(F.col(part) / TAILS).alias(common.fresh(wide.names, "group"))).applyInArrow(again, out)
    return table.filter(~F.col(tail)).select(*out.names).unionByName(tails)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(common.table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_length")


SQL = None
