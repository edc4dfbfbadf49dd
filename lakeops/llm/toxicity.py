"""Toxicity as cumulative-link ordinal regression on sparse text features.

Features are the distinct words of a text (A-Z lowered, letters and digits) and its
distinct byte 5-grams, which let rare forms of a word share weight, hashed into
``BUCKETS``. With weights w and ascending thresholds t_1 .. t_K,

    P(grade >= k) = 1 / (1 + exp(t_k - w . x)),

so all thresholds share the weights; expected severity is the sum of these K
probabilities. The model is fitted by full-batch gradient steps on a sample of about
``SAMPLE`` labelled documents per class (whole texts). Features enter the model if
their rates in toxic and other documents differ by ``MIN_Z`` standard errors, which keeps
very long texts from gathering noise; they are counted and tested by Spark, and the
driver holds the sample's features of that kind only.

The tables label toxic or not, without a degree. Degrees are therefore derived from the
sample: among toxic documents, the share of features that mark toxic documents (those
that pass the test above with a positive sign) is cut at its tertiles, which
gives grades 1, 2 and 3; other documents are grade 0. With graded labels, call ``fit``
directly.

Prediction reads whole texts and does not shuffle. Defined results: a null or empty text
has no features and gets the severity of the intercepts. Rows without a label, and
labels of unknown documents, teach nothing; a document with several labels counts with
its largest. Without both classes in the sample nothing is toxic: severity 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm import common, langid, words as W

BUCKETS = 1 << 20
SAMPLE = 6_000
MIN_Z = 3.5
STEPS = 300
RATE = 0.1
L2 = 1e-4
DECISION = 0.7  # the probability that a predicted grade has at least
GRADES = 3

PREDICTION = "struct<severity: double, toxic_probability: double, grade: int>"
_ARROW = pa.struct([("severity", pa.float64()), ("toxic_probability", pa.float64()), ("grade", pa.int32())])


@dataclass
class Sparse:
    """Rows of distinct feature numbers: row r has ``ids[offsets[r]:offsets[r + 1]]``."""

    ids: np.ndarray
    offsets: np.ndarray

    def dot(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(weights[self.ids])])
        return np.diff(total[self.offsets])

    def spread(self, values: np.ndarray, size: int) -> np.ndarray:
        """The sum of each feature's row values."""
        return np.bincount(self.ids, weights=np.repeat(values, np.diff(self.offsets)), minlength=size)


def features(column: pa.Array) -> Sparse:
    w, g = W.words(column, W.ALNUM_LOWER), langid.ngrams(column)
    n = len(column)
    rows = np.concatenate([w.rows(), np.repeat(np.arange(n), np.diff(g.offsets))])
    hashes = np.concatenate([w.hashes(), W.mix(g.values)])
    key = np.unique(rows.astype(np.int64) * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64))
    return Sparse((key % BUCKETS).astype(np.int32), np.searchsorted(key // BUCKETS, np.arange(n + 1)))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, x: Sparse) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K, by row."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - x.dot(self.weights)[:, None], -40, 40)))


def grades_of(share: np.ndarray, toxic: np.ndarray, levels: int = GRADES) -> np.ndarray:
    """0 for other rows; toxic rows 1 .. ``levels`` by quantiles of their share of marking features."""
    cuts = np.quantile(share[toxic], np.arange(1, levels) / levels)
    return np.where(toxic, 1 + np.searchsorted(cuts, share, side="left"), 0)


def fit(x: Sparse, grade: np.ndarray, size: int, levels: int = GRADES, steps: int = STEPS) -> Model:
    """Weights of features 0 .. ``size`` - 1 and thresholds of grades 0 .. ``levels``. Both
    sides of the first threshold weigh the same, however rare toxic rows are."""
    n = len(grade)
    toxic = grade > 0
    weight = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum()))
    w, first, gaps = np.zeros(size), 0.0, np.zeros(levels - 1)
    m1, m2 = np.zeros(len(w) + levels), np.zeros(len(w) + levels)
    for step in range(1, steps + 1):
        t = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        p = Model(w, t).at_least(x)
        above = np.column_stack([np.ones(n), p])  # P(grade >= k), k = 0 .. K
        below = np.column_stack([p, np.zeros(n)])  # P(grade >= k + 1)
        rows = np.arange(n)
        own = np.maximum(above[rows, grade] - below[rows, grade], 1e-12)
        slope = lambda q: q * (1 - q)
        up, down = slope(above[rows, grade]), slope(below[rows, grade])
        g_score = -weight * (up - down) / own
        g_t = np.zeros(levels)
        np.add.at(g_t, grade[toxic] - 1, (weight * up / own)[toxic])
        inner = grade < levels
        np.add.at(g_t, grade[inner], -(weight * down / own)[inner])
        after = np.cumsum(g_t[::-1])[::-1]
        g = np.concatenate([x.spread(g_score, size) + L2 * w, [after[0]], after[1:] * np.exp(gaps)])
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        w, first, gaps = w - move[: len(w)], first - move[len(w)], gaps - move[len(w) + 1:]
    return Model(w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


NOTHING = Model(np.zeros(BUCKETS), np.full(GRADES, np.inf))


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
          sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` documents per class, drawn by a hash of the key."""
    spark = docs.sparkSession
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("k")).agg((F.max(label) > 0).alias("toxic"))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return NOTHING
    share = F.when(F.col("toxic"), min(1.0, sample / counts[True])).otherwise(min(1.0, sample / counts[False]))
    drawn = known.filter(F.pmod(F.xxhash64("k"), F.lit(1_000_003)) < share * 1_000_003)
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(drawn), "k")  # bounded by ``sample``

    sampled = texts.select("toxic", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, upto, column in _chunks(b.column(1)):
                x, toxic = features(column), b.column(0).slice(first, upto - first).to_numpy(zero_copy_only=False)
                own = np.unique(x.ids)
                a, o = (x.spread(side.astype(float), BUCKETS)[own].astype(np.int64) for side in (toxic, ~toxic))
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(a), pa.array(o)], ["f", "a", "b"])

    rows = {r.toxic: r["count"] for r in sampled.groupBy("toxic").count().collect()}
    if len(rows) < 2:
        return NOTHING
    counts = sampled.mapInArrow(count, "f int, a bigint, b bigint").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    a, b, na, nb = F.col("a") + 0.5, F.col("b") + 0.5, rows[True] + 0.5 - F.col("a"), rows[False] + 0.5 - F.col("b")
    z = F.log(a * nb / (na * b)) / F.sqrt(1 / a + 1 / b + 1 / na + 1 / nb)
    chosen = counts.select("f", z.alias("z")).filter(F.abs("z") >= MIN_Z).orderBy("f").toArrow()
    number = np.full(BUCKETS, -1, dtype=np.int32)
    number[chosen["f"].to_numpy()] = np.arange(len(chosen))
    shared = spark.sparkContext.broadcast(number)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, upto, column in _chunks(b.column(1)):
                x = features(column)
                ids, own = shared.value[x.ids], np.diff(x.offsets)
                offsets = np.concatenate([[0], np.cumsum(ids >= 0)])[x.offsets]
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids[ids >= 0]))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, upto - first), pa.array(own), lists], ["toxic", "n", "ids"])

    found = sampled.mapInArrow(extract, "toxic boolean, n bigint, ids array<int>").toArrow()
    lists = pa.concat_arrays(found["ids"].chunks)
    x = Sparse(lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum([len(r) for r in lists])]))
    toxic = found["toxic"].to_numpy().astype(bool)
    share = x.dot((chosen["z"].to_numpy() > 0).astype(float)) / np.maximum(1, found["n"].to_numpy())
    small = fit(x, grades_of(share, toxic), len(chosen))
    weights = np.zeros(BUCKETS)
    weights[chosen["f"].to_numpy()] = small.weights
    return Model(weights, small.thresholds)


def _chunks(column: pa.Array) -> Iterator[tuple[int, int, pa.Array]]:
    column = column.cast(pa.large_string()).fill_null("")
    for first, upto in W.chunks(column):
        yield first, upto, column.slice(first, upto - first)


def predict(spark: SparkSession, model: Model):
    """A column function: text to ``PREDICTION``. ``grade`` is the largest of probability ``DECISION`` or more."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def severity(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in parts:
            none = np.zeros((0, len(shared.value.thresholds)))
            p = np.concatenate([none, *(shared.value.at_least(features(c)) for _, _, c in _chunks(column))])
            yield pa.StructArray.from_arrays(
                [pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array((p >= DECISION).sum(axis=1).astype(np.int32))], fields=list(_ARROW))

    return severity.asNondeterministic()  # never evaluated twice for one row


def with_severity(docs: DataFrame, name: str, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a column ``name`` of type ``PREDICTION``."""
    return docs.withColumn(name, predict(docs.sparkSession, model)(F.col(text)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, common.table(spark, sf_dir, "labels"))
    s = F.col("found")
    return with_severity(docs, "found", model).select(
        "doc_id", s["severity"].alias("severity"), s["toxic_probability"].alias("toxic_probability"),
        s["grade"].alias("grade"), (s["grade"] > 0).alias("toxic"))


SQL = None
