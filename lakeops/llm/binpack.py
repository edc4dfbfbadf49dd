"""Best-fit packing of documents into training sequences by bin completion.

Documents longer than ``CAPACITY`` tokens are cut into full pieces and a rest; all other
documents stay whole. Pieces go into as few sequences as can be found.

1. Documents are tokenised once and their pieces written as a table.
2. A plan needs only how many pieces there are of each length, at most ``CAPACITY``
   numbers whatever the size of the table. It is a list of fillings, each with its
   number of sequences:
   * best-fit decreasing gives the first solution to hold;
   * bin completion looks for a better one: around the largest piece left it enumerates
     fillings of the room beside it, largest pieces first, drops dominated ones (a piece
     left out could take the place of some inside that are together no longer, and
     still fit), and uses each for as many sequences as the counts allow;
   * a branch ends where the room wasted so far, and the room that the pieces over
     half a sequence must waste, leave no solution better than the one held. The search
     ends at the lower bound, or ``EFFORT`` steps after its first descent.
3. Pieces are numbered in order of (length, id, hash of the text, place) by range
   partitions. The plan, which is broadcast (a few numbers per filling), turns a number
   into a sequence and an offset, so no task gathers a sequence to fill it.
4. Places are joined to the written pieces by row. Only columns asked for are read again:
   token ids move once, and only if they are wanted.

``EFFORT`` and ``WIDTH`` bound the search for a plan, never the pieces: every plan holds
all of them, and ``packing_plan`` says how far it is from the lower bound.

Defined results: a null or empty text is its end token alone. Repeated rows are packed
each. The number of sequences depends on lengths alone; equal rows may take one
another's place. An empty table has no sequences. Other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeops.llm import common, tokens, words as W

CAPACITY = 2048
END = 0
EFFORT = 4000
WIDTH = 8
STEPS = 200  # of the enumeration of one room's fillings

Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing, equal lengths at once: (filling, sequences)."""
    open_: dict[int, list[tuple[Filling, int]]] = {}
    rooms: list[int] = []

    def put(room: int, filling: Filling, n: int) -> None:
        if n:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((filling, n))

    for s in sorted(counts, reverse=True):
        left = counts[s]
        while left:
            at = bisect_left(rooms, s)
            if at < len(rooms):
                room = rooms[at]
                filling, n = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, filling, n = capacity, (), left  # as many new ones as may be needed
            each = room // s
            full = min(n, left // each)
            put(room - each * s, (*filling, (s, each)), full)
            left, n = left - full * each, n - full
            if n and left and left < each:
                put(room - left * s, (*filling, (s, left)), 1)
                left, n = 0, n - 1
            if filling:
                put(room, filling, n)
    return [x for room in rooms for x in open_[room]]


def unavoidable(counts: dict[int, int], capacity: int) -> int:
    """Room that no packing can use: beside a piece of over half a sequence only
    pieces fit that are no longer than the rest of it."""
    small = sorted(s for s in counts if counts[s] and 2 * s <= capacity)
    at = carry = waste = 0
    for s in sorted((s for s in counts if counts[s] and 2 * s > capacity), reverse=True):
        while at < len(small) and small[at] <= capacity - s:
            carry += small[at] * counts[small[at]]
            at += 1
        room = counts[s] * (capacity - s)
        waste += max(0, room - carry)
        carry = max(0, carry - room)
    return waste


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    return -(-(sum(s * n for s, n in counts.items()) + unavoidable(counts, capacity)) // capacity)


class _Rest:
    """Counts of the pieces not yet packed."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {s: n for s, n in counts.items() if n}
        self.present = sorted(self.counts)
        self.bits = sum(1 << s for s in self.present)

    def change(self, filling: Filling, times: int) -> None:
        for s, each in filling:
            before = self.counts.get(s, 0)
            now = self.counts[s] = before - each * times
            if before and not now:
                del self.present[bisect_left(self.present, s)]
                self.bits ^= 1 << s
            elif now and not before:
                insort(self.present, s)
                self.bits |= 1 << s

    def times(self, filling: Filling) -> int:
        return min(self.counts[s] // each for s, each in filling)


def _dominated(chosen: list[int], rest: _Rest, used: dict[int, int], waste: int) -> bool:
    """A piece left out could stand for one or more of ``chosen``, which are together no
    longer, and still fit."""
    one = many = 0
    for s in chosen:
        many |= many << s | one << s
        one |= 1 << s
    free = rest.bits
    for s, n in used.items():
        if n and n == rest.counts[s]:
            free ^= 1 << s

    def reach(sums: int) -> int:  # sums, each made longer by 0 .. waste
        have = 0
        while have < waste:
            step = min(have + 1, waste - have)
            sums |= sums << step
            have += step
        return sums

    if reach(many) & free:
        return True
    if waste:
        waste -= 1
        return bool(reach(one << 1) & free)
    return False


def fillings(rest: _Rest, capacity: int, width: int, steps: int) -> list[tuple[int, Filling]]:
    """(waste, filling) around the largest piece left: those of least waste that no other
    dominates. ``steps`` and ``width`` 0: all of them."""
    largest = rest.present[-1]
    found: list[tuple[int, Filling]] = []
    spare: tuple[int, Filling] | None = None
    used = {largest: 1}
    chosen: list[int] = []
    room, limit, step = capacity - largest, largest, 0
    while True:
        at = bisect_right(rest.present, min(room, limit)) - 1
        while at >= 0 and used.get(rest.present[at], 0) >= rest.counts[rest.present[at]]:
            at -= 1
        if at >= 0:
            s = rest.present[at]
            chosen.append(s)
            used[s] = used.get(s, 0) + 1
            room, limit = room - s, s
            continue
        # Nothing more fits below the limit: a whole filling, if nothing fits at all.
        step += 1
        fits = any(used.get(s, 0) < rest.counts[s] for s in rest.present[: bisect_right(rest.present, room)])
        if not fits:
            pieces = {largest: 1}
            for s in chosen:
                pieces[s] = pieces.get(s, 0) + 1
            filling = (room, tuple(sorted(pieces.items(), reverse=True)))
            if not _dominated(chosen, rest, used, room):
                found.append(filling)
                if room == 0 and len(chosen) <= 1:
                    return [filling]  # one piece that fits exactly dominates all else
            elif spare is None or room < spare[0]:
                spare = filling
        if width and (step >= steps or sum(w == 0 for w, _ in found) >= width):
            break
        if not chosen:
            break
        s = chosen.pop()
        used[s] -= 1
        room, limit = room + s, s - 1
    found = sorted(set(found), key=lambda x: (x[0], [-s for s, _ in x[1]]))
    return (found[:width] if width else found) or [spare]


def complete(counts: dict[int, int], capacity: int, effort: int = EFFORT, width: int = WIDTH, steps: int = STEPS) -> tuple[list[tuple[Filling, int]], int]:
    """((filling, sequences) of the best plan found, lower bound of sequences). ``effort``
    counts steps after the first straight descent; ``width`` 0 with a large one is exact."""
    counts = {s: n for s, n in counts.items() if n}
    bound, total = lower_bound(counts, capacity), sum(s * n for s, n in counts.items())
    plan = best_fit(counts, capacity)
    held = sum(n for _, n in plan)
    if held == bound:
        return plan, bound
    rest = _Rest(counts)
    path: list[tuple[Filling, int, int]] = []  # filling, times, waste
    wasted, taken, straight, left = 0, 0, True, effort

    def options() -> Iterator[tuple[Filling, int, int]]:
        some = fillings(rest, capacity, width, steps)
        most = [(f, rest.times(f), w) for w, f in some]
        yield from most
        for f, times, w in most:  # a filling may also be right for fewer sequences
            for t in range(times - 1, 0, -1):
                yield f, t, w

    branches = [options()]
    while branches:
        allowed = (held - 1) * capacity - total
        choice = next(branches[-1], None)
        if not straight:
            left -= 1
            if left < 0:
                break
        if choice is None:
            branches.pop()
            straight = False
            if path:
                f, t, w = path.pop()
                rest.change(f, -t)
                wasted, taken = wasted - w * t, taken - t
            continue
        f, t, w = choice
        if wasted + w * t > allowed:
            straight = False
            continue
        rest.change(f, t)
        if not rest.present:
            plan, held, straight = [*((x, n) for x, n, _ in path), (f, t)], taken + t, False
            rest.change(f, -t)
            if held == bound:
                break
            continue
        if not straight and wasted + w * t + unavoidable(rest.counts, capacity) > allowed:
            rest.change(f, -t)
            continue
        path.append((f, t, w))
        wasted, taken = wasted + w * t, taken + t
        branches.append(options())
    return plan, bound


@dataclass
class Plan:
    """Where the pieces, numbered from 0 by length, go. Entry e holds the numbers from
    ``start[e]`` on, of pieces of ``size[e]``: ``each[e]`` of them in a sequence."""

    start: np.ndarray
    size: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    bound: int

    def __call__(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each piece."""
        e = np.searchsorted(self.start, numbers, side="right") - 1
        local = numbers - self.start[e]
        return self.sequence[e] + local // self.each[e], self.offset[e] + local % self.each[e] * self.size[e]


def packing_plan(counts: dict[int, int], capacity: int, effort: int = EFFORT) -> Plan:
    chosen, bound = complete(counts, capacity, effort)
    begin, upto = {}, 0
    for s in sorted(counts):
        begin[s], upto = upto, upto + counts[s]
    rows, sequence = [], 0
    for filling, n in chosen:
        offset = 0
        for s, each in filling:
            rows.append((begin[s], s, each, sequence, offset))
            begin[s], offset = begin[s] + each * n, offset + each * s
        sequence += n
    columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, sequence, bound)


def pieces(docs: DataFrame, *, key: str, text: str, path: str, capacity: int, end: int) -> DataFrame:
    """``k``, ``t`` (hash of the text), ``piece``, ``start``, ``length``, ``ids_crc32`` and ``ids``."""
    kind = docs.schema[key].dataType
    schema = T.StructType([
        T.StructField("k", kind), T.StructField("t", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenise = tokens.word_tokeniser(path)
        for b in batches:
            for first, upto in W.chunks(b.column(2)):
                t = tokenise(b.column(2).slice(first, upto - first), end)
                n = np.diff(t.offsets)
                per = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), per)
                piece = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                at = np.append(t.offsets[row] + start, t.offsets[-1])  # pieces of a chunk follow one another
                raw = t.ids.astype("<u4").tobytes()
                crc = [zlib.crc32(memoryview(raw)[4 * x: 4 * y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
                ids = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer((4 * at).astype(np.int32).tobytes()), pa.py_buffer(raw)])
                rows = pa.array(first + row)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                     pa.array(crc, pa.int64()), ids], schema.names)

    return docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("t"), F.col(text)).mapInArrow(run, schema)


def pack(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY,
    end_token: int = END, effort: int = EFFORT,
) -> DataFrame:
    """One row per piece: ``key``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset`` and ``ids`` (little-endian unsigned 32-bit)."""
    spark = docs.sparkSession
    cut = pieces(docs, key=key, text=text, path=vocabulary or tokens.vocabulary_path(), capacity=capacity, end=end_token)
    table = common.written(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r[0]: r[1] for r in table.groupBy("length").count().collect()}  # at most ``capacity`` rows
    shared = spark.sparkContext.broadcast(packing_plan(counts, capacity, effort))

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(numbers: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(x) for x in shared.value(numbers.to_numpy())], ["sequence_id", "offset"])

    by_length = common.numbered(table.select("length", "k", "t", "piece", "row"), ["length", "k", "t", "piece"], "number", "by-length")
    placed = by_length.select("row", place.asNondeterministic()("number").alias("place"))
    out = table.join(placed, "row")
    return out.select(
        F.col("k").alias(key), "piece", "start", "length", "ids_crc32", F.col("place")["sequence_id"].alias("sequence_id"),
        F.col("place")["offset"].alias("offset"), "ids")


def assembled(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``n_tokens`` and ``ids`` of whole sequences."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined: Column = F.aggregate(parts, F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents")).drop("ids")


SQL = None
