"""Line dedup by winnowing over line hashes. DataFrame functions only.

A text is split at line feeds; a line counts if it holds anything but blanks, and is
compared without the blanks around it. A window is ``WINDOW`` consecutive counting
lines of one document; a document of fewer, but not none, is one window. Short windows
are added: one or more, but fewer, consecutive counting lines with ``WORDS`` words or
more in all (runs of anything but blanks). A line goes if some window that covers it has
the same lines as a window that starts earlier: in a document of a smaller id, or in the
same document further up.

1. Each document's line hashes and word counts are written once, a few bytes a line.
   Winnowing: the least line hash of each window is its fingerprint (the leftmost of
   equal ones). Equal windows choose the same line, so a repeated window is guaranteed
   to have a fingerprint that occurs at two positions. Fingerprints of one position
   are dropped here, and with them almost all of a corpus.
2. Positions of the other fingerprints are joined: their windows, which reach from the
   fingerprint line to both sides, are folded to the first place of each.
3. Windows that are not at their first place grow together to both sides into maximal
   runs, which are cut from the text, blank lines inside them too.

Folds are aggregates with map-side combination. A fingerprint, or a window, that a
third of all documents hold meets its one folded row in an equi-join, whose hot
partitions AQE splits. A document is gathered only with its own line numbers.

Defined results: a null text stays null, an empty one empty. A null id is smaller than
any other. Rows of one id and one text are one document: none loses lines to its
twin. Rows of one id and other texts are judged each on its own against smaller ids.
Any other columns are kept as they are.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.llm import common

WINDOW = 3
WORDS = 50
BLANKS = " \t\n\x0b\f\r"


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per document with a counting line: ``k``, ``t`` (the text's hash), and of these lines ``h``,
    the hashes, and ``v``, the numbers of words."""
    bare = F.filter(F.transform(F.split(F.col(text), "\n"), _bare), lambda line: F.length(line) > 0)
    lines = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.xxhash64(text).alias("t"), bare.alias("lines"))
    words = F.transform("lines", lambda line: F.regexp_count(line, F.lit(r"[^ \t\n\x0B\f\r]+")))
    return lines.filter(F.size("lines") > 0).select("k", "t", F.transform("lines", lambda line: F.xxhash64(line)).alias("h"), words.alias("v"))


def windows(lines: DataFrame, width: int = WINDOW, words: int = WORDS) -> DataFrame:
    """``k``, ``t``, ``h`` and ``w``: an array of each window's first line ``i``, number of lines
    ``m``, fingerprint ``f`` at line ``p``, and hash ``g`` of all its lines."""
    n = F.size("h")
    shifted = [F.slice(c, F.lit(j + 1), n).alias(f"{c}{j}") for j in range(width) for c in ("h", "v")]
    zipped = lines.select("k", "t", "h", F.arrays_zip(*shifted).alias("w"))

    def of(w: Column, i: Column, m: int) -> Column:
        parts = [w[f"h{j}"] for j in range(m)]  # null behind the last line, which hashes and least() skip
        least = F.least(*parts) if m > 1 else parts[0]
        at = F.coalesce(*(F.when(h == least, F.lit(j)) for j, h in enumerate(parts)))
        return F.struct(
            i.alias("i"), F.least(F.lit(m), n - i).alias("m"), least.alias("f"), (i + at).alias("p"), F.xxhash64(*parts).alias("g"))

    def at(w: Column, i: Column) -> Column:
        long = F.when((i == 0) | w[f"h{width - 1}"].isNotNull(), of(w, i, width))
        short = []
        for m in range(1, width):
            enough = functools.reduce(operator.add, (w[f"v{j}"] for j in range(m))) >= words
            short.append(F.when(enough & (n > m), of(w, i, m)))  # a text of m lines is a window anyway
        return F.array_compact(F.array(long, *short))

    return zipped.select("k", "t", "h", F.flatten(F.transform("w", at)).alias("w"))


def repeated_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = WINDOW, words: int = WORDS) -> DataFrame:
    """``k``, ``t`` and ``gone``: the sorted numbers of the counting lines in windows that occur earlier."""
    own = windows(common.written(_lines(docs, key, text), "lines"), width, words)
    marked = F.array_distinct(F.transform("w", lambda w: w["p"]))  # a line is the fingerprint of several windows
    # The outer forms: no text is without a window, and the others evaluate it twice, to filter.
    marks = own.select(F.explode_outer(F.transform(marked, lambda p: F.element_at("h", p + 1))).alias("f"))
    twice = marks.groupBy("f").agg(F.count("*").alias("n")).filter("n > 1").select("f")
    placed = own.select("k", "t", F.inline_outer("w")).join(twice, "f")
    place = F.struct(F.col("k").isNotNull().alias("has"), "k", "i")
    first = placed.groupBy("f", "g").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = placed.join(first, ["f", "g"]).filter(place > F.col("first"))
    covered = F.flatten(F.collect_set(F.sequence("i", F.col("i") + F.col("m") - 1)))
    return later.groupBy("k", "t").agg(F.array_sort(F.array_distinct(covered)).alias("gone"))


def _cut(lines: Column, gone: Column, at: Column) -> Column:
    """``lines`` less the runs that the counting lines ``gone`` form; ``at`` has the index of
    each counting line."""
    before = F.concat(F.array(F.lit(-2)), F.slice(gone, 1, F.size(gone) - 1))
    after = F.concat(F.slice(gone, 2, F.size(gone) - 1), F.array(F.lit(2**31 - 1)))
    opens = F.filter(F.zip_with(gone, before, lambda c, b: F.when(c - b > 1, c)), lambda c: c.isNotNull())
    closes = F.filter(F.zip_with(gone, after, lambda c, a: F.when(a - c > 1, c)), lambda c: c.isNotNull())
    first_line = F.transform(opens, lambda c: F.element_at(at, c + 1))
    after_line = F.transform(closes, lambda c: F.element_at(at, c + 1) + 1)
    gaps = F.zip_with(
        F.concat(F.array(F.lit(0)), after_line), F.concat(first_line, F.array(F.size(lines))),
        lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
    return F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["a"] + 1, g["n"])))


def dedup_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = WINDOW, words: int = WORDS,
                counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with repeated runs cut from ``text``; ``counts`` names two more columns:
    counting lines, and how many of them went."""
    hashed, lines, at, gone = (common.fresh([*docs.columns, *(counts or ())], c) for c in ("hash", "lines", "at", "gone"))
    runs = repeated_lines(docs, key=key, text=text, width=width, words=words).withColumnsRenamed({"gone": gone})
    runs = runs.withColumnsRenamed({"k": common.fresh(docs.columns, "k_"), "t": common.fresh(docs.columns, "t_")})
    k, t, _ = runs.columns
    joined = docs.withColumn(hashed, F.xxhash64(text)).join(
        runs, F.col(key).eqNullSafe(F.col(k)) & (F.col(hashed) == F.col(t)), "left").drop(k, t, hashed)
    # ``lines`` and ``at`` are read more than once below, so they stay columns of their own.
    split = joined.withColumn(lines, F.split(text, "\n"))
    counting = F.filter(F.transform(F.col(lines), lambda line, i: F.struct(i.alias("i"), F.length(_bare(line)).alias("n"))), lambda x: x["n"] > 0)
    split = split.withColumn(at, F.transform(counting, lambda x: x["i"]))
    left = _cut(F.col(lines), F.col(gone), F.col(at))
    out = split.withColumn(text, F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(left, "\n")))
    if counts:
        n = F.coalesce(F.size(F.col(at)), F.lit(0))
        out = out.withColumn(counts[0], F.when(F.col(text).isNull(), 0).otherwise(n).cast("bigint"))
        out = out.withColumn(counts[1], F.coalesce(F.size(F.col(gone)), F.lit(0)).cast("bigint"))
    return out.drop(lines, at, gone)


def without_repeated_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = WINDOW, words: int = WORDS) -> DataFrame:
    """``dedup_lines`` less the documents of which all counting lines went, columns unchanged."""
    n, gone = common.fresh(docs.columns, "n_lines"), common.fresh(docs.columns, "n_removed")
    out = dedup_lines(docs, key=key, text=text, width=width, words=words, counts=(n, gone))
    return out.filter((F.col(gone) == 0) | (F.col(gone) < F.col(n))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs, counts=("n_lines", "n_removed"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = rf"""
WITH line AS (
    SELECT doc_id, i, s, trim(s, E' \t\n\x0b\f\r') AS b
    FROM (SELECT doc_id, unnest(l) AS s, unnest(range(len(l))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))),
counting AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS c, count(*) OVER (PARTITION BY doc_id) AS n,
        len(regexp_extract_all(b, '[^\x20\x09-\x0D]+')) AS v FROM line WHERE b <> ''),
win AS (
    SELECT doc_id, c, n, array_agg(b) OVER d AS w, array_agg(v) OVER d AS v
    FROM counting WINDOW d AS (PARTITION BY doc_id ORDER BY c ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
sized AS (  -- windows of m lines: the long ones, whole texts, and short ones with enough words
    SELECT doc_id, c, m, list_slice(w, 1, m) AS w FROM (SELECT *, unnest(range(1, {WINDOW + 1})) AS m FROM win)
    WHERE c + m <= n AND (m = {WINDOW} OR n = m OR list_sum(list_slice(v, 1, m)) >= {WORDS})),
ranked AS (SELECT doc_id, c, m, row_number() OVER (PARTITION BY w ORDER BY doc_id, c) AS r FROM sized),
run AS (SELECT doc_id, c AS a, c + m - 1 AS b FROM ranked WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS c FROM run),
span AS (  -- a gone line, and the blank ones up to the next counting line if that is gone too
    SELECT doc_id, i AS a, CASE WHEN lead(c) OVER d = c + 1 THEN lead(i) OVER d - 1 ELSE i END AS b
    FROM gone JOIN counting USING (doc_id, c) WINDOW d AS (PARTITION BY doc_id ORDER BY c)),
cut AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM span),
kept AS (
    SELECT doc_id, string_agg(s, chr(10) ORDER BY i) AS text
    FROM line LEFT JOIN cut USING (doc_id, i) WHERE cut.doc_id IS NULL GROUP BY doc_id)
SELECT doc_id, (SELECT count(*) FROM counting c WHERE c.doc_id = d.doc_id) AS n_lines,
       (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)"""
