"""Language identification with language-bitmask n-gram filters.

Training counts the byte n-grams of labelled texts per language and keeps each
language's ``GRAMS`` most frequent ones. They go into one bit-sliced Bloom filter: a
slot holds one bit per language, so ANDing the slots of an n-gram returns all
languages that contain it at once. A text's n-grams are looked up whole; per language
the set bits are counted and corrected for false positives: with N n-grams, n of them
found and a false-positive rate p (the share of slots with the language's bit, to the
power of the number of hash functions), the expected number of true members is
(n - N p) / (1 - p). The language with most members wins; the score is its share of
all languages' members.

A text must also be known enough: if its best language has a smaller share of the text's
n-grams than that language's ``least``, the score is 0. ``least`` is half of the 5th
percentile of this share among every fifth training row, measured with the n-grams of
the other rows; a language without such rows takes the lowest ``least`` of the others.

The classifier is fitted on a sample of about ``SAMPLE`` labelled texts per language
(all of them where a language has fewer), whole texts each. The filter has
``GRAMS`` entries per language whatever the corpus, which bounds what is collected and
broadcast. Prediction reads every text from its first byte to its last, without a
shuffle.

Defined results: a text that is null or has no letter is ``und`` with score 0. A text
with letters but no known n-gram gets the language with most training rows, score 0. Ties
go to the first language by name. With nothing to learn from, all rows are ``und``.
Rows without language or id teach nothing; a null id is not held out. Only the text is
an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeops.llm import common, words as W

NGRAM = 5  # bytes around each letter byte: two before, itself, two after
GRAMS = 50_000
SAMPLE = 2_000
SLOTS = 1 << 20
HASHES = 3
UNKNOWN = "und"
MIN_SCORE = 0.0
FOLD = 5  # every fifth training row sets ``least``
LOW, MARGIN = 0.05, 0.5

PREDICTION = "struct<lang: string, score: double>"
_ARROW = pa.struct([("lang", pa.string()), ("score", pa.float64())])
_BLANK = 0x20
_READS = np.array(
    [b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else _BLANK for b in range(256)], dtype=np.uint8)


@dataclass
class Grams:
    """n-grams of some rows, each the little-endian number of its bytes."""

    values: np.ndarray
    offsets: np.ndarray


def ngrams(column: pa.Array) -> Grams:
    """One n-gram around every letter or non-ASCII byte of each row. Rows are
    surrounded by blanks, and all other characters read as blanks."""
    data, offsets = W.bytes_of(column)
    n, half = len(offsets) - 1, NGRAM // 2
    row = np.repeat(np.arange(n), np.diff(offsets))
    at = np.arange(len(data)) + (2 * row + 1) * half
    padded = np.full(len(data) + 2 * half * n + 8, _BLANK, dtype=np.uint8)
    padded[at] = _READS[data]
    centres = at[padded[at] != _BLANK] if len(data) else at
    blocks = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    values = blocks[centres - half] & np.uint64((1 << (8 * NGRAM)) - 1)
    return Grams(values, np.searchsorted(centres, offsets + (2 * np.arange(n + 1)) * half))


def _slots(values: np.ndarray) -> Iterator[np.ndarray]:
    h = W.mix(values + np.uint64(1))
    step = W.mix(h) | np.uint64(1)
    for _ in range(HASHES):
        yield (h % np.uint64(SLOTS)).astype(np.int64)
        h = h + step


@dataclass
class Model:
    """``bits[w]`` holds, per slot, a byte with the bits of languages 8w to 8w + 7."""

    languages: list[str]
    bits: np.ndarray
    false_rate: np.ndarray
    prior: int
    least: np.ndarray

    @staticmethod
    def fit(languages: list[str], grams: list[np.ndarray], rows: list[int], least: list[float] | None = None) -> Model:
        bits = np.zeros((max(1, -(-len(languages) // 8)), SLOTS), dtype=np.uint8)
        fill = []
        for i, values in enumerate(grams):
            plane, bit = bits[i // 8], np.uint8(1 << i % 8)
            for s in _slots(values):
                plane[s] |= bit
            fill.append(float((plane & bit > 0).mean()))
        return Model(languages, bits, np.array(fill) ** HASHES, int(np.argmax(rows)) if rows else 0,
                     np.array(least if least is not None else [0.0] * len(languages)))

    def members(self, g: Grams) -> tuple[np.ndarray, np.ndarray]:
        """Corrected number of n-grams in each language, by row; n-grams by row."""
        total = np.diff(g.offsets)
        out = np.zeros((len(total), len(self.languages)))
        slots = list(_slots(g.values))
        for plane_at, plane in enumerate(self.bits):
            mask = plane[slots[0]]
            for s in slots[1:]:
                mask &= plane[s]
            for i in range(8 * plane_at, min(8 * plane_at + 8, len(self.languages))):
                found = np.concatenate([[0], np.cumsum(mask >> np.uint8(i % 8) & np.uint8(1), dtype=np.int64)])
                p = self.false_rate[i]
                out[:, i] = np.maximum(0, (np.diff(found[g.offsets]) - total * p) / (1 - p))
        return out, total

    def predict(self, column: pa.Array) -> tuple[list[str], list[float]]:
        g = ngrams(column)
        langs, scores = [], []
        members, total = self.members(g) if self.languages else (None, np.diff(g.offsets))
        for row, text in enumerate(column):
            if not self.languages or total[row] == 0 or not any(map(str.isalpha, text.as_py())):
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            m, s = members[row], float(members[row].sum())
            best = int(np.argmax(m)) if s > 0 else self.prior
            langs.append(self.languages[best])
            scores.append(float(m[best]) / s if s > 0 and m[best] >= self.least[best] * total[row] else 0.0)
        return langs, scores


def held_out(doc_id: Column) -> Column:
    """Every fifth document by checksum of its id; never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(labelled: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
          sample: int = SAMPLE, grams: int = GRAMS) -> Model:
    """Fit on about ``sample`` rows per language, chosen by a hash of the key."""
    rows = labelled.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    rows = rows.filter(F.col("l").isNotNull() & F.col("t").isNotNull())
    counts = sorted(tuple(r) for r in rows.groupBy("l").count().collect())
    if not counts:
        return Model.fit([], [], [])
    share = F.create_map(*[x for name, n in counts for x in (F.lit(name), F.lit(min(1.0, sample / n)))])
    drawn = (F.xxhash64("k") % 1_000_003 + 1_000_003) % 1_000_003 < share[F.col("l")] * 1_000_003

    fold = F.pmod(F.xxhash64("k", F.lit("fold")), F.lit(FOLD)) == 0
    rows = rows.filter(drawn).select("l", "t", fold.alias("own"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column(0).unique():
                for fold in (False, True):
                    own = b.column(1).filter(pc.and_(pc.equal(b.column(0), name), pc.equal(b.column(2), fold)))
                    for first, upto in W.chunks(own):
                        values, n = np.unique(ngrams(own.slice(first, upto - first)).values, return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name.as_py()] * len(n), pa.string()), pa.array(values.astype(np.int64)), pa.array(n),
                             pa.array([fold] * len(n), pa.bool_())],
                            ["l", "g", "n", "own"])

    counted = rows.mapInArrow(count, "l string, g bigint, n bigint, own boolean")
    best = Window.partitionBy("l").orderBy(F.desc("n"), "g")
    top = (
        counted.groupBy("l", "g").agg(F.sum("n").alias("n"), F.bool_or(~F.col("own")).alias("other"))
        .withColumn("at", F.row_number().over(best)).filter(F.col("at") <= grams)
        .select("l", "g", "other").toArrow()
    )
    names = [name for name, _ in counts]
    own = {n: top.filter(pc.equal(top["l"], n)) for n in names}
    of = lambda table: table["g"].to_numpy().astype(np.uint64)
    others = Model.fit(names, [of(own[n].filter(own[n]["other"])) for n in names], [n for _, n in counts])
    return Model.fit(names, [of(own[n]) for n in names], [n for _, n in counts], _least(rows.filter("own"), others))


def _least(rows: DataFrame, model: Model) -> list[float]:
    """By language, the share of n-grams that ``model`` must know of a text: from rows
    (``l``, ``t``) that it has not seen."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, upto in W.chunks(b.column(1)):
                members, total = shared.value.members(ngrams(b.column(1).slice(first, upto - first)))
                names = b.column(0).slice(first, upto - first)
                at = np.array([shared.value.languages.index(n) for n in names.to_pylist()], dtype=np.int64)
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(some)), pa.array(members[some, at[some]] / total[some])], ["l", "share"])

    shares = rows.select("l", "t").mapInArrow(known, "l string, share double")
    low = {r.l: MARGIN * r.low for r in shares.groupBy("l").agg(F.percentile("share", LOW).alias("low")).collect()}
    return [low.get(n, min(low.values(), default=0.0)) for n in model.languages]


def predict(spark: SparkSession, model: Model):
    """A column function: text to ``PREDICTION``."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def lang(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in parts:
            column = column.cast(pa.large_string()).fill_null("")
            langs, scores = [], []
            for first, upto in W.chunks(column):
                for have, more in zip((langs, scores), shared.value.predict(column.slice(first, upto - first))):
                    have += more
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], fields=list(_ARROW))

    return lang.asNondeterministic()  # never evaluated twice for one row


def with_language(docs: DataFrame, name: str, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a column ``name`` of type ``PREDICTION``."""
    return docs.withColumn(name, predict(docs.sparkSession, model)(F.col(text)))


def identified(docs: DataFrame, model: Model, *, text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` whose language is known with a score above ``min_score`` (0: enough of the
    n-grams are known), columns unchanged."""
    name = common.fresh(docs.columns, "language")
    found = with_language(docs, name, model, text)
    return found.filter((F.col(name)["lang"] != UNKNOWN) & (F.col(name)["score"] > min_score)).drop(name)


def learn_from(docs: DataFrame) -> DataFrame:
    """The rows of documents that training may see."""
    return docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = train(learn_from(docs))
    found = with_language(docs.select("doc_id", "text"), "language", model)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        F.col("language")["lang"].alias("lang_pred"), F.col("language")["score"].alias("score"))


SQL = None
