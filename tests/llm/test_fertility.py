"""Counts against plain Python; bands on a small corpus."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from lakeops.llm import fertility as Q, tokens

PATH = tokens.vocabulary_path(Q.VOCABULARY)
word = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = word.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if word.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i: i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i: i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def measured(texts):
    return Q.measure(pa.array(texts, pa.large_string()), PATH).to_pylist()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "B", "é", "#x", "\n", "\n\n", "\t", "<日>", "a b c", "\r", "\x1c"]), max_size=25).map(" ".join), min_size=1, max_size=6))
def test_counts(texts):
    for text, m in zip(texts, measured(texts), strict=True):
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"]) == brute(text)


def test_lines_without_separators():
    texts = ["a\na\n\na", "\na\na", "a\n", "", "a a\na a\n a a", "x" * 70 + "\n" + "x" * 70]
    assert [m["n_dup_lines"] for m in measured(texts)] == [brute(t)[3] for t in texts]


def test_tokens():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    text = "The quick brown fox 漢𠮷 jumps über the lazy dog."
    ids = [i for w in text.split() for i in model.encode(w)]
    (m,) = measured([text])
    p = [n / len(ids) for n in Counter(ids).values()]
    assert m["n_tokens"] == len(ids)
    assert math.isclose(m["chars_per_token"], sum(map(len, text.split())) / len(ids))
    assert math.isclose(m["byte_share"], sum(map(model.is_byte, ids)) / len(ids))
    assert math.isclose(m["entropy"], -sum(x * math.log2(x) for x in p))
    assert [m["script"] for m in measured(["abc é", "где", "漢字", "12 !"])] == ["latin", "cyrillic", "han", "none"]


def test_shared_counts_and_verdicts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in Q.query(spark, sf).collect():
        n = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r.kept and r.base_failed)


def middle(values):
    return sorted(values)[math.ceil(len(values) / 2) - 1]


def smoothed(classes, at, line):
    """classes: size -> (documents, value); the weighted mean, or line, at one size."""
    rank = {size: i for i, size in enumerate(sorted(classes))}
    rows = [(size - at, n * Q.PULL ** abs(rank[size] - rank[at]), v) for size, (n, v) in classes.items()]
    w = sum(r[1] for r in rows)
    x, y = sum(r[0] * r[1] for r in rows) / w, sum(r[2] * r[1] for r in rows) / w
    spread = sum(r[1] * (r[0] - x) ** 2 for r in rows)
    if not line or spread == 0:
        return y
    return y - x * sum(r[1] * (r[0] - x) * (r[2] - y) for r in rows) / spread


def test_verdicts_equal_plain_bands(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    found = [r.asDict() | {"lang": lang[r.doc_id]} for r in Q.verdicts(docs).collect()]
    groups = {}
    for r in found:
        r["size"] = int(math.floor(math.log2(max(1, r["n_tokens"]))))
        if not r["base_failed"]:
            groups.setdefault(r["lang"], {}).setdefault(r["size"], []).append(r)
    ratios, bands = ("chars_per_token", "byte_share", "entropy"), {}
    for g, classes in groups.items():
        for c in ratios:
            raw = {size: (len(rows), middle([r[c] for r in rows])) for size, rows in classes.items()}
            centre = {size: smoothed(raw, size, False) for size in classes}
            if c == "entropy":
                centre = {size: min(centre[size], smoothed(raw, size, len(classes) > 1)) for size in classes}
            away = {size: (len(rows), 1.4826 * middle([abs(r[c] - centre[size]) for r in rows])) for size, rows in classes.items()}
            for size in classes:
                bands[g, size, c] = centre[size], smoothed(away, size, False)
    wrong = 0
    for r in found:
        kept = not r["base_failed"]
        if kept:
            (ca, cs), (ba, bs), (ea, es) = (bands[r["lang"], r["size"], c] for c in ratios)
            kept = not (
                r["entropy"] - ea < -(Q.ENTROPY_BAND * es + Q.ROUNDING) or abs(r["chars_per_token"] - ca) > Q.CHARS_BAND * cs + Q.ROUNDING
                or r["byte_share"] - ba > Q.BYTES_BAND * bs + Q.ROUNDING + Q.BYTES_SLACK)
        wrong += kept != r["kept"]
    assert wrong == 0 and 0 < sum(r["kept"] for r in found) < len(found)


def test_bands_reject_foreign_texts(spark, sf):
    docs = spark.read.parquet(sf.replace("0.001", "0.1") + "/documents.parquet")
    labels = spark.read.parquet(sf.replace("0.001", "0.1") + "/labels.parquet")
    found = Q.verdicts(docs).join(labels, "doc_id").filter("not base_failed")
    share = {r.quality: r.share for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.99 and share[0] < 0.15


def test_a_rare_language_has_its_own_bands(spark):
    rnd = random.Random(4)
    english = "the house water people number first great world during history between government large under small".split()
    chinese = [chr(0x4E00 + rnd.randrange(2000)) + chr(0x4E00 + rnd.randrange(2000)) for _ in range(400)]
    text = lambda pool, n: " ".join(rnd.choice(pool) + rnd.choice(["", "s", "ing"]) if pool is english else rnd.choice(pool) for _ in range(n))
    rows = [(i, text(english, rnd.randint(300, 700)), "en") for i in range(600)]
    rows += [(1000 + i, text(chinese, rnd.randint(60, 160)), "zh") for i in range(30)]
    rows += [(2000, text(english, 2500), "zh"), (2001, text(chinese, 5000), "en")]  # each in the wrong language, alone in its length class
    found = {r.doc_id: r for r in Q.verdicts(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not any(r.base_failed for r in found.values())
    assert sum(found[1000 + i].kept for i in range(30)) >= 28
    assert sum(found[i].kept for i in range(600)) > 0.95 * 600
    assert not found[2001].kept


def test_nulls_and_empty_tables(spark):
    schema = "doc_id bigint, text string, lang string, n_words string, grp int, m int"
    assert Q.verdicts(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, None, None, "x", 1, 1), (None, "", "en", "x", 1, 1), (2, "a b", "en", "x", 1, 1), (2, "a b", "en", "x", 1, 1), (3, "w " * 20000, None, "x", 1, 1)]
    got = Q.verdicts(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept, r.entropy is None) for r in got) == [
        (0, 0, True, False, True), (1, 0, True, False, True), (2, 2, True, False, False), (2, 2, True, False, False),
        (3, 20000, True, False, False)]
    by_script = Q.verdicts(spark.createDataFrame(rows, schema), group=None)
    assert by_script.count() == 5
