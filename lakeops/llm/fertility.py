"""Quality rules on tokeniser fertility.

A public vocabulary was fitted to ordinary text. Text it was not made for breaks into
many tokens, into bytes, or into the same few tokens again and again. Each whole text
is tokenised word by word and measured: characters per token, the share of
byte-fallback tokens, and the entropy of its token ids in bits.

Every group of documents has rejection bands. A group is a language (or, without a
language column, the script of most letters) and a length class (the binary logarithm
of the number of tokens, rounded down), because entropy grows with length. A band is
a centre plus and minus a multiple of a standard deviation, over all documents of the
language that pass the base rule, and both are smooth in the length: the centre is the
mean of the medians of the length classes, the deviation that of 1.4826 times their median
absolute deviations from the centre. A class counts by its number of documents, times
``PULL`` for each class of the language that it is away. The centre of entropy is that
mean, or a line through the medians where that is lower, as short texts need. So a class of
few documents leans on its neighbours in the same language, never on another language, at
any table size; a language's only document is its own measure and passes.

The base rule: at least 50 words, and at most half of the words in 3-word windows that
occur twice or more in the text.

Bands come from approximate percentiles (one row per group, smoothed per language), measures are written once
to the shared folder. Texts are never shuffled.

Defined results: a null or empty text has zeros, no measures, and fails the base rule.
A null language is a group of its own. Repeated rows count each. A document is judged
only by measures that exist.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.llm import common, tokens, words as W

VOCABULARY = "piece_bpe_32k.model"
MIN_WORDS = 50
ENTROPY_BAND = 3.0
CHARS_BAND = 5.0
BYTES_BAND = 3.0
BYTES_SLACK = 0.05
PULL = 0.25
ROUNDING = 1e-9
ACCURACY = 10_000

MEASURES = (
    "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, n_repeat_words: bigint, "
    "n_tokens: bigint, chars_per_token: double, byte_share: double, entropy: double, script: string>"
)
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")
_RATIOS = ("chars_per_token", "byte_share", "entropy")
_ARROW = pa.struct([*((c, pa.int64()) for c in _COUNTS), *((c, pa.float64()) for c in _RATIOS), ("script", pa.string())])

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
_NEWLINE = 0x0A
# Scripts by the first byte of a UTF-8 character.
_SCRIPTS = ("none", "latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "kana", "han", "hangul", "other")
_LEADS = np.zeros(256, dtype=np.uint8)
for _script, _ranges in {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xCA)], "greek": [(0xCD, 0xCF)], "cyrillic": [(0xD0, 0xD4)],
    "hebrew": [(0xD6, 0xD7)], "arabic": [(0xD8, 0xDD)], "indic": [(0xE0, 0xE0)], "other": [(0xCB, 0xCC), (0xD5, 0xD5), (0xDE, 0xDF), (0xE1, 0xE1), (0xEE, 0xF4)],
    "kana": [(0xE3, 0xE3)], "han": [(0xE4, 0xE9)], "hangul": [(0xEA, 0xED)],
}.items():
    for _a, _b in _ranges:
        _LEADS[_a: _b + 1] = _SCRIPTS.index(_script)


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(total[offsets])


def _repeat_words(w: W.Words, hashes: np.ndarray) -> np.ndarray:
    """Words in 3-word windows that occur twice or more in their row."""
    rows, n = w.rows(), max(0, len(hashes) - 2)
    inside = rows[:n] == rows[2: n + 2] if n else np.zeros(0, dtype=bool)
    at = np.flatnonzero(inside)
    key = W.mix(W.grams(hashes, 3)[at] + rows[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = np.zeros(len(hashes), dtype=bool)
    for shift in range(3):
        hit[at[count[inverse] > 1] + shift] = True
    return _sums(hit, w.offsets)


def _dup_lines(w: W.Words, offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    breaks = np.flatnonzero(raw == _NEWLINE)
    starts = np.union1d(offsets[:-1][np.diff(offsets) > 0], breaks + 1)
    starts = starts[starts < len(raw)]
    row = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], len(raw)), offsets[row + 1])
    ends = ends - ((ends > starts) & (raw[np.maximum(ends, 1) - 1] == _NEWLINE))
    has_word = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends, row = starts[has_word], ends[has_word], row[has_word]
    key = W.mix(W.hash_spans(raw, starts, ends) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    later = np.ones(len(key), dtype=bool)
    later[first] = False
    return np.bincount(row[later], minlength=len(offsets) - 1)


def _entropy(ids: np.ndarray) -> float:
    if len(ids) == 0:
        return 0.0
    _, n = np.unique(ids, return_counts=True)
    p = n / len(ids)
    return float(abs(-(p * np.log2(p)).sum()))


def measure(column: pa.Array, path: str) -> pa.StructArray:
    """``MEASURES`` of each row of a large string column without nulls."""
    tokenise, is_byte = tokens.piece_tokeniser(path)
    w, (raw, offsets) = W.words(column), W.bytes_of(column)
    t = tokenise(column)
    first_byte = np.concatenate([[0], np.cumsum(raw & 0xC0 != 0x80)])
    chars = np.concatenate([[0], np.cumsum(first_byte[w.ends] - first_byte[w.starts])])
    n_tokens = np.diff(t.offsets)
    word_chars = np.diff(chars[w.offsets])
    with np.errstate(invalid="ignore", divide="ignore"):
        ratio = word_chars / n_tokens
        share = _sums(is_byte[t.ids], t.offsets) / n_tokens
    none = n_tokens == 0
    entropy = np.array([_entropy(t.ids[a:b]) for a, b in zip(t.offsets[:-1], t.offsets[1:])], dtype=float)
    lead = _LEADS[raw]
    by_script = np.stack([_sums(lead == s, offsets) for s in range(1, len(_SCRIPTS))], axis=1)
    script = np.where(by_script.sum(axis=1) > 0, by_script.argmax(axis=1) + 1, 0)
    counts = [w.counts(), word_chars, _sums(_SYMBOLS[raw], offsets), _dup_lines(w, offsets, raw), _repeat_words(w, w.hashes()), n_tokens]
    return pa.StructArray.from_arrays(
        [*(pa.array(c.astype(np.int64)) for c in counts), *(pa.array(r, mask=none) for r in (ratio, share, entropy)),
         pa.array([_SCRIPTS[s] for s in script], pa.string())], fields=list(_ARROW))


def measures(path: str | None = None):
    """A column function: text to ``MEASURES``."""
    path = path or tokens.vocabulary_path(VOCABULARY)

    @F.arrow_udf(MEASURES)
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in parts:
            column = column.cast(pa.large_string()).fill_null("")
            found = [measure(column.slice(a, b - a), path) for a, b in W.chunks(column)]
            yield pa.concat_arrays(found) if found else pa.array([], _ARROW)

    return run.asNondeterministic()  # never evaluated twice for one row


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def _smoothed(size: np.ndarray, n: np.ndarray, values: np.ndarray, degree: int) -> np.ndarray:
    """At each length class, the weighted fit of a polynomial to the values of all classes."""
    out, rank = np.zeros(len(size)), np.argsort(np.argsort(size))
    for i, at in enumerate(size):
        away = (size - at).astype(float)
        root = np.sqrt(n * PULL ** np.abs(rank - rank[i]))
        terms = np.stack([away ** d for d in range(degree + 1)], axis=1)
        out[i] = np.linalg.lstsq(terms * root[:, None], values * root, rcond=None)[0][0]
    return out


def _along_lengths(classes: DataFrame, columns: list[str]) -> DataFrame:
    """``grp``, ``size``, ``n``, and ``columns`` smoothed over the classes of each ``grp``."""

    def smooth(t: pa.Table) -> pa.Table:
        size, n = t["size"].to_numpy(), t["n"].to_numpy()
        fitted = {c: _smoothed(size, n, t[c].to_numpy(), 0) for c in columns}
        if "entropy_at" in fitted:
            fitted["entropy_at"] = np.minimum(fitted["entropy_at"], _smoothed(size, n, t["entropy_at"].to_numpy(), 1))
        return pa.table({"grp": t["grp"], "size": t["size"], "n": t["n"], **fitted})

    return classes.groupBy("grp").applyInArrow(smooth, "grp string, size bigint, n bigint, " + ", ".join(f"{c} double" for c in columns))


def _bands(measured: DataFrame) -> DataFrame:
    """Centre and spread of each ratio, by ``grp`` and ``size``; all rows are counted."""
    by = ["grp", "size"]
    middle = lambda c: F.percentile_approx(c, 0.5, ACCURACY)
    centre = measured.groupBy(*by).agg(F.count("*").alias("n"), *(middle(c).alias(f"{c}_at") for c in _RATIOS))
    centre = common.written(_along_lengths(centre, [f"{c}_at" for c in _RATIOS]), "centres")
    spread = _joined(measured, centre, by).groupBy(*by).agg(F.count("*").alias("n"), *(
        (1.4826 * middle(F.abs(F.col(c) - F.col(f"{c}_at")))).alias(f"{c}_sd") for c in _RATIOS))
    spread = _along_lengths(spread, [f"{c}_sd" for c in _RATIOS])
    return _joined(centre.drop("n"), spread.drop("n"), by)


def _joined(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join on columns that may be null; AQE broadcasts the few rows of groups."""
    right = right.withColumnsRenamed({b: f"_{b}" for b in by})
    on = [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by]
    return left.join(right, on, how).drop(*(f"_{b}" for b in by))


def verdicts(docs: DataFrame, *, key: str = "doc_id", text: str = "text", group: str | None = "lang", path: str | None = None) -> DataFrame:
    """One row per document: ``key``, the measures, ``base_failed`` and ``kept``."""
    found = docs.select(F.col(key), (F.col(group) if group else F.lit(None)).cast("string").alias("grp"), measures(path)(F.col(text)).alias("m"))
    own_group = F.col("grp") if group else F.col("m")["script"].alias("grp")
    found = found.select(key, own_group, "m.*", base_failed(F.col("m")).alias("base_failed"))
    found = found.withColumn("size", F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))))
    found = common.written(found, "measures")
    good = found.filter(~F.col("base_failed")).select("grp", "size", *_RATIOS)
    judged = _joined(found, _bands(good), ["grp", "size"], "left")
    away = lambda c: F.col(c) - F.col(f"{c}_at")
    band = lambda c, times: times * F.col(f"{c}_sd") + ROUNDING
    outside = (
        (away("entropy") < -band("entropy", ENTROPY_BAND))
        | (F.abs(away("chars_per_token")) > band("chars_per_token", CHARS_BAND))
        | (away("byte_share") > band("byte_share", BYTES_BAND) + BYTES_SLACK)
    )
    kept = ~F.col("base_failed") & ~F.coalesce(outside, F.lit(False))
    return judged.select(key, *_COUNTS, *_RATIOS, "script", "base_failed", kept.alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = verdicts(common.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "chars_per_token", "byte_share", "entropy")


SQL = None
