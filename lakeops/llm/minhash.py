"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

A document's set has its distinct word shingles (A-Z lowered; a shorter text is one
shingle). Documents whose sets have a Jaccard similarity of at least 0.8 are linked,
and a class is what links connect.

1. Documents with equal sets form one class from the start.
2. Min-max hashing: each of ``PERMUTATIONS`` hash functions gives two signature values,
   the minimum and the maximum, for one evaluation. ``ROWS`` values make a band; two
   sets of similarity s share a band with probability s**ROWS. With 38 bands a pair at
   0.8 is missed in 3 cases of 10 million, others less.
3. Classes that share a band form a bucket. A bucket is a star: each member is compared
   with two leaders (the smallest id and the smallest hash), never all with all, so
   the number of pairs is linear whatever the bucket's size. Pairs whose sizes alone
   rule out 0.8 are dropped; the others are confirmed on full sets and connected.
4. What stars leave: classes that share a bucket with a class of another component.
   Among them an exact prefix filter applies. With shingles in a fixed order, rarest
   first, two sets of n and m shingles can reach 0.8 only if their first
   n - ceil(0.8 n) + 1 and m - ceil(0.8 m) + 1 shingles meet. An edited copy that is too
   far from the rest has only shingles of its own in front, and meets none. Classes that
   meet across components form families. A family is cut into blocks of about ``BLOCK``
   classes; a task gets two blocks and counts all overlaps of their full sets as one
   matrix product, so pairs are never rows and only links come out.

A document may come with another version of its text (``one_of_each``): then it has two
sets, and is linked where either of them is.

Defined results: null texts and texts without words have an empty set and are linked
with nothing. Rows of one id and one text are one document; rows of one id and other
texts, null ids too, are judged each by its own text. A null id is kept as it is, greater
than any other as a class name. Of rows that share the smallest id of a class, or that
are all without one, those with the smallest text hash are kept. Only ids and texts
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeops.llm import common, graph, words as W

SHINGLE = 4
ROWS = 5
BANDS = 38
PERMUTATIONS = ROWS * BANDS // 2
PERCENT = 80
BLOCK = 256
_COLUMNS = 8192

_A, _B = (W.mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, -1))
_A |= np.uint64(1)


def shingle_sets(column: pa.Array, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a large string column."""
    for first, upto in W.chunks(column):
        w = W.words(column.slice(first, upto - first), W.SPACED_LOWER)
        h, grams = w.hashes(), None
        grams = W.grams(h, k)
        for a, b in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist()):
            if b - a >= k:
                yield np.unique(grams[a: b - k + 1])
            else:
                yield W.grams(h[a:b], b - a) if b > a else np.zeros(0, dtype=np.uint64)


def signature(s: np.ndarray, step: int = 4096) -> np.ndarray:
    """Minimum and maximum under each permutation: ``2 * PERMUTATIONS`` values."""
    low, high = np.full(PERMUTATIONS, ~np.uint64(0)), np.zeros(PERMUTATIONS, dtype=np.uint64)
    for i in range(0, len(s), step):  # so that a long text needs no large matrix
        h = s[None, i: i + step] * _A[:, None] + _B[:, None]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(low, h.min(axis=1), out=low)
        np.maximum(high, h.max(axis=1), out=high)
    return np.concatenate([low, high])


def bands(sig: np.ndarray) -> np.ndarray:
    """Hash of each band's values; minima and maxima of one permutation lie far apart."""
    return W.mix(W.grams(sig, ROWS)[::ROWS][:BANDS] + np.arange(BANDS, dtype=np.uint64))


def _set_hash(s: np.ndarray) -> int:
    return int(W.mix(np.add.reduce(W.mix(s), keepdims=True) + np.uint64(len(s)))[0].astype(np.int64))


def _own(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``k``, ``t`` (hash of the document's text), ``x`` (hash of this text) and ``text``."""
    return docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("t"), F.xxhash64(text).alias("x"), F.col(text).alias("text"))


def sketches(texts: DataFrame, k: int) -> DataFrame:
    """``k``, ``t``, ``x``, ``n`` (set size), ``c`` (hash of the set) and ``bands`` of ``_own`` texts."""
    schema = T.StructType([
        texts.schema["k"], T.StructField("t", T.LongType()), T.StructField("x", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("c", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(3).cast(pa.large_string()).fill_null("")
            n, c, keys = [], [], []
            for s in shingle_sets(column, k):
                n.append(len(s))
                c.append(_set_hash(s) if len(s) else None)
                keys.append(bands(signature(s)).astype(np.int64) if len(s) else np.zeros(0, dtype=np.int64))
            lengths = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
            flat = pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *keys]))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.ListArray.from_arrays(pa.array(lengths), flat)], schema.names)

    return texts.mapInArrow(run, schema)


def _similar_sizes(a, b, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _texts(own: DataFrame, classes: DataFrame) -> DataFrame:
    """The text of each of ``classes`` (``c``, one row each), by the id ``rep`` and the
    hash ``x`` of one of its texts."""
    rows = own.select(F.col("k").alias("k_"), F.col("x").alias("x_"), "text")
    found = rows.join(classes.select("c", "rep", "x"), F.col("k_").eqNullSafe(F.col("rep")) & (F.col("x_") == F.col("x")))
    return found.groupBy("c").agg(F.max("text").alias("text"))


def confirmed(pairs: DataFrame, texts: DataFrame, *, k: int, percent: int) -> DataFrame:
    """``a`` and ``b`` of the pairs whose full sets are similar enough. Texts travel, not
    sets, which are several times larger; neighbouring pairs share their first text."""

    @F.arrow_udf("boolean")
    def linked(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, held = None, None
        for ones, others in parts:
            out = []
            for x, y in zip(ones, others):
                if last is None or not x.equals(last):
                    last, held = x, next(shingle_sets(pa.array([x.as_py()], pa.large_string()), k))
                s = next(shingle_sets(pa.array([y.as_py()], pa.large_string()), k))
                both = len(np.intersect1d(held, s, assume_unique=True))
                out.append(100 * both >= percent * (len(held) + len(s) - both))
            yield pa.array(out, pa.bool_())

    one = texts.withColumnsRenamed({"c": "a", "text": "text_a"})
    other = texts.withColumnsRenamed({"c": "b", "text": "text_b"})
    joined = pairs.select("a", "b").join(other, "b").join(one, "a")
    return joined.filter(linked.asNondeterministic()("text_a", "text_b")).select("a", "b")


def _prefixes(rest: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """``c``, ``comp``, ``n`` and each prefix shingle ``s`` that another class has too."""

    @F.arrow_udf("array<bigint>")
    def shingles(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in parts:
            sets = [s.astype(np.int64) for s in shingle_sets(column.cast(pa.large_string()), k)]
            yield pa.array(sets, pa.list_(pa.int64()))

    own = common.written(rest.join(texts, "c").select("c", "comp", "n", F.explode(shingles.asNondeterministic()("text")).alias("s")), "shingles")
    often = own.groupBy("s").agg(F.count("*").alias("df")).filter("df > 1")
    # Shingles of one class come first in the order and need no row: they only use up
    # places of the prefix.
    shared = own.join(often, "s").groupBy("c", "comp", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("have"))
    places = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    left = F.greatest(F.lit(0).cast("bigint"), places - (F.col("n") - F.size("have"))).cast("int")
    return shared.select("c", "comp", "n", F.explode(F.slice("have", 1, left)).alias("x")).select("c", "comp", "n", F.col("x")["s"].alias("s"))


def overlaps(ones: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """The number of common members of each pair of sets."""
    flat = np.concatenate([*ones, *others])
    shared, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1  # members of one set only need no column
    row = np.repeat(np.arange(len(ones) + len(others)), [len(x) for x in (*ones, *others)])
    keep = count[place] > 1
    row, column = row[keep], number[place[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(ones), len(others)), dtype=np.int64)
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, _COLUMNS):
        part = slice(*np.searchsorted(column, [first, first + _COLUMNS]))
        m = np.zeros((len(ones) + len(others), _COLUMNS), dtype=np.float32)
        m[row[part], column[part] - first] = 1
        out += np.rint(m[: len(ones)] @ m[len(ones):].T).astype(np.int64)
    return out


def _family_links(prefix: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """``a`` and ``b``: links between components among classes whose prefixes meet."""
    split = prefix.groupBy("s").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("c").alias("leader"))
    met = prefix.join(split.filter("low <> high"), "s").select("c", "leader", "comp").distinct()
    met = common.written(met, "met")
    families = graph.components(met.select("c", "leader")).withColumnsRenamed({"node": "c", "component": "family"})
    member = met.select("c", "comp").distinct().join(families, "c")
    size = member.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    member = common.written(member.join(size, "family"), "members").join(texts, "c")
    member = member.withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    cells = member.select("*", other.alias("other"))
    cells = cells.select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "c", "comp", "text")

    def compare(cell: pa.Table) -> pa.Table:
        c, comp, own = (cell[x].to_numpy() for x in ("c", "comp", "own"))
        texts = cell["text"].combine_chunks().cast(pa.large_string())
        texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
        sets = list(shingle_sets(texts, k))
        n = np.array([len(x) for x in sets])
        one = np.flatnonzero(own == cell["i"][0].as_py())
        two = np.flatnonzero(own == cell["j"][0].as_py())
        both = overlaps([sets[x] for x in one], [sets[x] for x in two])
        a, b = np.nonzero((100 * both >= percent * (n[one][:, None] + n[two][None, :] - both)) & (comp[one][:, None] != comp[two][None, :]))
        return pa.table({"a": pa.array(c[one[a]], pa.int64()), "b": pa.array(c[two[b]], pa.int64())})

    return cells.groupBy("family", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def _place(k: str):
    return F.struct(F.col(k).isNull().alias("last"), F.col(k).alias("rep"), "t", "x")


def _judged(own: DataFrame, k: int, percent: int) -> DataFrame:
    """One row per document of ``own`` (see ``_own``; rows of which ``x`` is not ``t`` are versions of
    a document): ``k``, ``t``, ``n``, ``component_id`` and ``kept``."""
    rows = common.written(sketches(own, k), "sketches")
    some = rows.filter("n > 0")
    # the sets of one document are linked from the start
    sets = some.groupBy("k", "t").agg(F.min("c").alias("a"), F.max("c").alias("b")).filter("a <> b").select("a", "b").distinct()
    buckets = some.groupBy("c").agg(F.first("bands").alias("bands"), F.min(_place("k")).alias("place"), F.min("n").alias("n"))
    buckets = common.written(buckets.select("c", "bands", F.col("place")["rep"].alias("rep"), F.col("place")["t"].alias("t"), F.col("place")["x"].alias("x"), "n"), "classes")
    classes = buckets.drop("bands")
    member = buckets.select("c", "rep", "n", F.explode("bands").alias("band"))
    lead = F.struct(F.col("rep").isNull().alias("last"), "rep", "c", "n")
    star = member.groupBy("band").agg(F.min(lead).alias("one"), F.min(F.struct("c", "n")).alias("two"), F.count("*").alias("m")).filter("m > 1").drop("m")
    # A class meets the same leaders in many bands, so pairs are folded before anything else.
    met = member.join(star, "band").select(
        F.col("c").alias("b"), F.col("n").alias("nb"),
        F.explode(F.array(F.struct(F.col("one")["c"].alias("c"), F.col("one")["n"].alias("n")), F.col("two"))).alias("leader"))
    pairs = met.select(F.col("leader")["c"].alias("a"), "b", F.col("leader")["n"].alias("na"), "nb").filter("a <> b")
    pairs = pairs.filter(_similar_sizes(F.col("na"), F.col("nb"), percent))
    pairs = common.written(pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct().withColumnsRenamed({"x": "a", "y": "b"}), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    texts = common.written(_texts(own, classes.join(ends, "c")), "texts")
    links = common.written(confirmed(pairs, texts, k=k, percent=percent).unionByName(sets), "links")
    joined = common.written(graph.components(links), "components")

    # Exactly, what the stars leave.
    named = member.drop("rep").join(joined.withColumnsRenamed({"node": "c", "component": "comp"}), "c", "left")
    named = named.withColumn("comp", F.coalesce("comp", "c"))
    mixed = named.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("band")
    rest = common.written(named.join(mixed, "band").groupBy("c").agg(F.min("comp").alias("comp"), F.min("n").alias("n")), "rest")
    rest_texts = common.written(_texts(own, classes.join(rest.select("c"), "c")), "texts")
    prefix = common.written(_prefixes(rest, rest_texts, k, percent), "prefixes")
    late = common.written(_family_links(prefix, rest_texts, k, percent), "links")
    whole = graph.components(links.unionByName(late)).withColumnsRenamed({"node": "c", "component": "comp"})

    labelled = classes.join(whole, "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    first = labelled.groupBy("comp").agg(F.min(_place("rep")).alias("first"))
    named = common.written(labelled.join(first, "comp").select("c", "first"), "named")
    out = rows.filter("t = x").select("k", "t", "n", "c").join(named, "c", "left")
    kept = F.col("first").isNull() | (F.col("k").eqNullSafe(F.col("first")["rep"]) & (F.col("t") == F.col("first")["t"]))
    return out.select("k", "t", "n", F.coalesce(F.col("first")["rep"], "k").alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``key``, ``n_shingles``, ``component_id`` (the smallest id of
    its class) and ``kept`` (it is that one)."""
    out = _judged(_own(docs, key, text), k, percent)
    return out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), "component_id", "kept")


def _versions(docs: DataFrame, other: DataFrame, key: str, text: str) -> DataFrame:
    """The texts of ``other`` that differ from that of the document of the same id, as in
    ``_own``. An id that ``other`` has twice names no text, so it has no version."""
    hashes = other.groupBy(F.col(key).alias("k")).agg(F.max(F.xxhash64(text)).alias("x"), F.count("*").alias("rows")).filter("rows = 1 AND k IS NOT NULL")
    changed = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("t")).distinct().join(hashes.drop("rows"), "k").filter("t <> x")
    texts = other.select(F.col(key).alias("k"), F.xxhash64(text).alias("x"), F.col(text).alias("text"))
    return texts.join(changed, ["k", "x"]).select("k", "t", "x", "text")


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT,
                other: DataFrame | None = None) -> DataFrame:
    """``docs`` with one document of each class: the smallest id, columns unchanged. ``other``
    (``key``, ``text``) has further versions of the texts, which link documents as well."""
    own = _own(docs, key, text)
    if other is not None:
        own = own.unionByName(common.written(_versions(docs, other, key, text), "versions"))  # read several times
    mine, gone, hashed = (common.fresh(docs.columns, c) for c in ("own_hash", "gone_id", "gone_hash"))
    found = _judged(own, k, percent).filter("not kept").select(F.col("k").alias(gone), F.col("t").alias(hashed)).distinct()
    on = F.col(key).eqNullSafe(F.col(gone)) & (F.col(mine) == F.col(hashed))
    return docs.withColumn(mine, F.xxhash64(text)).join(found, on, "left_anti").drop(mine)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"))


SQL = rf"""
WITH RECURSIVE word AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {SHINGLE} - 1), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE} + 1, 1) + 1)) AS i FROM word WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
    SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
    WHERE 100 * common.n >= {PERCENT} * (x.n + y.n - common.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN size USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)"""
