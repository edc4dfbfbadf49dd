"""Substring dedup with suffix automata over reference shards.

A window is ``WINDOW`` consecutive words of one document. A word goes if some window
that covers it has the same words as a window that starts earlier: in a document of a
smaller id, or further up in the same one.

An automaton of every document met by every document would cost the square of the
corpus, and no shard of a large corpus fits a task whole. So documents meet only the
shards that can hold a match:

1. Each window chooses an anchor, its least 4-word hash (leftmost of equal ones); equal
   windows choose the same. Neighbouring windows of one anchor form a segment. Anchors
   are folded: how many segments, the smallest id, and whether all their segments are
   alike. Anchors of one document and one segment are dropped: no window of theirs occurs
   twice.
2. Anchors whose segments are all alike are settled: every document but the first loses
   the segment's windows.
3. The other segments are reference shards, dealt by anchor. A shard builds one suffix
   automaton over its distinct segments in order of (id, start): each is streamed through
   what is built so far, and where the matching statistic reaches ``WINDOW`` the
   window occurs earlier; then it joins the automaton. Repeats of a segment lose all of it.
4. An anchor of more than ``HOT`` segments (the edge of a passage that very many documents
   share, or a phrase that one text repeats with other words between) would make a shard
   of unbounded size. The windows of its distinct segments are folded
   one by one instead, by a hash of all their words, to the first place of each.

Texts are read three times and shuffled twice (to attach a document's anchors, and its
ranges). Folds are aggregates with map-side combination; folded rows are joined with
equi-joins whose hot partitions AQE splits. Words are compared by 64-bit hashes, windows
by at least two of them.

Defined results: a null or empty text has no words. A null id is greater than any other.
Rows of one id and one text are one document (its ranges are cut from each row). Rows of
one id and other texts, null ids too, are documents in order of the text's hash. A text of which
nothing goes is still rewritten with single blanks between its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm import common, words as W

WINDOW = 20
GRAM = 4
HOT = 1000
SHARD = 4000
HELD = 100_000
LAST_ID = (1 << 63) - 1

_EVENTS = "kind int, k bigint, t bigint, s bigint, n bigint, a bigint, x bigint, words binary"
_GONE, _OCCURS, _SEGMENT, _HOT = range(4)


class Segments:
    """Runs of windows that share an anchor, for some rows of a column: row, first
    word (from the row's start), number of windows, anchor, hash of all words."""

    def __init__(self, column: pa.Array, width: int):
        w = W.words(column)
        self.hashes, self.offsets = w.hashes(), w.offsets
        rows = w.rows()
        at = W.window_minima(W.grams(self.hashes, GRAM), width - GRAM + 1)
        n = len(self.hashes) - width + 1
        windows = np.flatnonzero(rows[:n] == rows[width - 1:]) if n > 0 else np.zeros(0, dtype=np.int64)
        anchor = at[windows]
        new = np.ones(len(windows), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (rows[windows[1:]] != rows[windows[:-1]])
        self.first = windows[new]
        self.count = np.diff(np.append(np.flatnonzero(new), len(windows)))
        self.row = rows[self.first]
        self.start = self.first - self.offsets[self.row]
        self.ranges = W.RangeHash(self.hashes)
        self.anchor = W.grams(self.hashes, GRAM)[anchor[new]].astype(np.int64)
        self.text = self.ranges(self.first, self.first + self.count + width - 1).astype(np.int64)


def _chunks(column: pa.Array) -> Iterator[tuple[int, int, pa.Array]]:
    column = column.cast(pa.large_string()).fill_null("")
    for first, upto in W.chunks(column):
        yield first, upto, column.slice(first, upto - first)


def anchors(docs: DataFrame, width: int) -> DataFrame:
    """``a``, ``lo``, ``hi``, ``c``, ``k``, ``t``: per document and anchor the extremes of its
    segments' hashes, and how many it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, hashes = b.column(0).to_numpy(), b.column(1).to_numpy()
            for first, _, column in _chunks(b.column(2)):
                g = Segments(column, width)
                order = np.lexsort((g.text, g.anchor, g.row))
                row, anchor, text = g.row[order], g.anchor[order], g.text[order]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
                begin = np.flatnonzero(new)
                end = np.append(begin[1:], len(order)) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[begin]), pa.array(text[begin]), pa.array(text[end[: len(begin)]]), pa.array(end[: len(begin)] - begin + 1),
                     pa.array(keys[first + row[begin]]), pa.array(hashes[first + row[begin]])],
                    ["a", "lo", "hi", "c", "k", "t"])

    return docs.select("k", "t", "text").mapInArrow(run, "a bigint, lo bigint, hi bigint, c bigint, k bigint, t bigint")


def _folded(seen: DataFrame, hot: int) -> DataFrame:
    """``a``, ``least`` and ``code`` of the anchors that occur twice: 1 segments all alike, 2 for
    a shard, 3 too many segments for one."""
    document = F.struct("k", "t")
    folded = seen.groupBy("a").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min(document).alias("least"), F.max(document).alias("most"), F.sum("c").alias("n"))
    code = F.when(F.col("lo") == F.col("hi"), 1).when(F.col("n") <= hot, 2).otherwise(3)
    return folded.filter("lo <> hi or least <> most").select("a", "least", code.alias("code"))


class SuffixAutomaton:
    """Of several sequences; grows one sequence at a time."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, edges: dict[int, int], link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int]) -> None:
        last = 0
        for c in sequence:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
                continue
            new, p = self._state({}, 0, self.length[last] + 1), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
            last = new

    def matching(self, sequence: list[int]) -> Iterator[int]:
        """For each place the length of the longest match that ends there."""
        state, length = 0, 0
        for c in sequence:
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if c in self.next[state]:
                state, length = self.next[state][c], length + 1
            yield length


def _events(docs: DataFrame, width: int) -> DataFrame:
    """What each document's anchors settle, and what they leave open (``_EVENTS``).
    ``docs`` has ``k``, ``t``, ``text``, and arrays ``alike``, ``mixed`` and ``hot`` of anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[int, tuple[int, int, int]] = {}
        for b in batches:
            keys, hashes = b.column(0).to_numpy(), b.column(1).to_numpy()
            for first, upto, column in _chunks(b.column(2)):
                g = Segments(column, width)
                part = b.slice(first, upto - first)
                state = np.zeros(len(g.row), dtype=np.int8)
                begin = np.searchsorted(g.row, np.arange(upto - first + 1))
                for code, at in ((1, 3), (2, 4), (3, 5)):
                    lists = part.column(at)
                    for r in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)).tolist():
                        own = slice(begin[r], begin[r + 1])
                        state[own][np.isin(g.anchor[own], lists[r].values.to_numpy())] = code
                # the same segment again in one document
                order = np.lexsort((g.first, g.text, g.row))
                again = np.zeros(len(order), dtype=bool)
                again[order[1:]] = (g.row[order[1:]] == g.row[order[:-1]]) & (g.text[order[1:]] == g.text[order[:-1]])
                k, t = (x[first + g.row] if len(g.row) else np.zeros(0, dtype=np.int64) for x in (keys, hashes))
                gone = np.flatnonzero((state == 1) | again)
                out = [(_GONE, k[gone], t[gone], g.start[gone], g.count[gone], None, None, None)]
                mixed = np.flatnonzero((state >= 2) & ~again)
                out.append((_OCCURS, k[mixed], t[mixed], g.start[mixed], g.count[mixed], None, g.text[mixed], None))
                fresh = []
                for i, x, place in zip(mixed.tolist(), g.text[mixed].tolist(), zip(k[mixed].tolist(), t[mixed].tolist(), g.start[mixed].tolist())):
                    before = sent.get(x)
                    if before is None or place < before:  # only the first place of a segment counts
                        if len(sent) >= HELD:
                            sent.clear()
                        sent[x] = place
                        fresh.append(i)
                fresh = np.array(fresh, dtype=np.int64)
                raw = [
                    g.hashes[a: a + n + width - 1].astype("<u8").tobytes() if code == 2 else None
                    for a, n, code in zip(g.first[fresh].tolist(), g.count[fresh].tolist(), state[fresh].tolist())]
                out.append((_SEGMENT, k[fresh], t[fresh], g.start[fresh], g.count[fresh], g.anchor[fresh], g.text[fresh], raw))
                hot = fresh[state[fresh] == 3]
                n = g.count[hot]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(g.first[hot], n) + step
                out.append((_HOT, np.repeat(k[hot], n), np.repeat(t[hot], n), np.repeat(g.start[hot], n) + step, np.ones(len(at), dtype=np.int64),
                            np.repeat(g.anchor[hot], n), g.ranges(at, at + width).astype(np.int64), None))
                for kind, ks, ts, s, c, a, x, text in out:
                    if len(ks):
                        none = pa.nulls(len(ks), pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(ks), kind, dtype=np.int32)), pa.array(ks), pa.array(ts), pa.array(s), pa.array(c),
                             none if a is None else pa.array(a), none if x is None else pa.array(x),
                             pa.nulls(len(ks), pa.binary()) if text is None else pa.array(text, pa.binary())],
                            ["kind", "k", "t", "s", "n", "a", "x", "words"])

    return docs.mapInArrow(run, _EVENTS)


def _shard(width: int):
    """One shard: the windows of each segment's first place that occur earlier."""

    def run(table: pa.Table) -> pa.Table:
        first: dict[int, tuple[int, int, int, bytes]] = {}
        for x, k, t, s, raw in zip(*(table[c].to_pylist() for c in ("x", "k", "t", "s", "words"))):
            if x not in first or (k, t, s) < first[x][:3]:
                first[x] = (k, t, s, raw)
        automaton, rows = SuffixAutomaton(), []
        for x, (k, t, s, raw) in sorted(first.items(), key=lambda item: item[1][:3]):
            sequence = np.frombuffer(raw, dtype="<u8").tolist()
            for end, length in enumerate(automaton.matching(sequence)):
                if length >= width:
                    rows.append((k, t, s + end - width + 1, 1))
            automaton.add(sequence)
        return pa.table({c: pa.array([r[i] for r in rows], pa.int64()) for i, c in enumerate(("k", "t", "s", "n"))})

    return run


def repeated_ranges(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = WINDOW, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """``k`` (the id; null: ``LAST_ID``), ``t`` (hash of the text) and ``gone``: an array of (``s``, ``n``), n windows
    from word s on that occur earlier."""
    own = docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(LAST_ID)).alias("k"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    seen, document = anchors(own, width), F.struct("k", "t")
    folded = common.written(_folded(seen, hot), "anchors")
    met = seen.select("a", "k", "t").join(folded, "a").filter((F.col("code") != 1) | (document > F.col("least")))
    lists = {name: F.collect_list(F.when(F.col("code") == c, F.col("a"))) for c, name in ((1, "alike"), (2, "mixed"), (3, "hot"))}
    lists = {name: F.when(F.size(c) > 0, c).alias(name) for name, c in lists.items()}
    own_anchors = common.written(met.groupBy("k", "t").agg(*lists.values()), "own-anchors")
    events = common.written(_events(own.join(own_anchors, ["k", "t"], "left").select("k", "t", "text", "alike", "mixed", "hot"), width), "events")

    of = lambda kind: events.filter(F.col("kind") == kind)
    segments = of(_SEGMENT).filter("words IS NOT NULL")
    shards = max(1, segments.count() // shard)
    judged = segments.withColumn("shard", F.pmod("a", F.lit(shards))).groupBy("shard").applyInArrow(
        lambda t: _shard(width)(t), "k bigint, t bigint, s bigint, n bigint")
    place = F.struct("k", "t", "s")
    begin = of(_SEGMENT).groupBy("x").agg(F.min(place).alias("first"))
    later = of(_OCCURS).join(begin, "x").filter(place > F.col("first")).select("k", "t", "s", "n")
    windows = of(_HOT).select("a", "x", "k", "t", "s")
    top = windows.groupBy("a", "x").agg(F.min(place).alias("first"), F.count("*").alias("m")).filter("m > 1").drop("m")
    single = windows.join(top, ["a", "x"]).filter(place > F.col("first")).select("k", "t", "s", F.lit(1).cast("bigint").alias("n"))
    ranges = of(_GONE).select("k", "t", "s", "n").unionByName(later).unionByName(judged).unionByName(single)
    return common.written(ranges.groupBy("k", "t").agg(F.collect_set(F.struct("s", "n")).alias("gone")), "ranges")


_CUT = "struct<n_words: bigint, n_removed: bigint, kept: string>"
_CUT_ARROW = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _cutter(width: int):
    @F.arrow_udf(_CUT)
    def cut(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ranges in parts:
            n, removed, kept = [], [], []
            for text, gone in zip(texts, ranges):
                words = (text.as_py() or "").encode().split()
                n.append(len(words))
                if gone.is_valid:
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    s = np.minimum(gone.values.field("s").to_numpy(), len(words))
                    np.add.at(change, s, 1)
                    np.add.at(change, np.minimum(s + gone.values.field("n").to_numpy() + width - 1, len(words)), -1)
                    left = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
                    words = [words[i] for i in left]
                removed.append(n[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], fields=list(_CUT_ARROW))

    return cut.asNondeterministic()  # never evaluated twice for one row


def dedup_substrings(docs: DataFrame, name: str, *, key: str = "doc_id", text: str = "text", width: int = WINDOW, **options) -> DataFrame:
    """``docs`` with a column ``name``: words, how many went, and the text that is left."""
    k, t, gone = (common.fresh(docs.columns, c) for c in ("k", "t", "gone"))
    ranges = repeated_ranges(docs, key=key, text=text, width=width, **options).withColumnsRenamed({"k": k, "t": t, "gone": gone})
    on = (F.coalesce(F.col(key).cast("bigint"), F.lit(LAST_ID)) == F.col(k)) & (F.xxhash64(docs[text]) == F.col(t))
    return docs.join(ranges, on, "left").withColumn(name, _cutter(width)(F.col(text), F.col(gone))).drop(k, t, gone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.col("found")
    return dedup_substrings(docs, "found").select(
        "doc_id", found["n_words"].alias("n_words"), found["n_removed"].alias("n_removed"), F.sha2(found["kept"], 256).alias("kept_sha256"))


SQL = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
    SELECT doc_id, i, hash(list_slice(w, i, i + {WINDOW - 1})) AS h, md5(array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM doc WHERE len(w) >= {WINDOW})),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h, s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT doc_id, list(DISTINCT j) AS g FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS j FROM later) GROUP BY doc_id),
kept AS (
    SELECT doc_id, string_agg(v, ' ' ORDER BY j) AS text, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS j FROM doc) word
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(g) AS j FROM gone) x WHERE x.doc_id = word.doc_id AND x.j = word.j) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)"""
