"""Every window against every earlier one, on all three ways (alike, shards, hot)."""

import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from lakeops.llm import substrings as D


def brute(rows, width=20):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(w) - width + 1):
            window = tuple(w[i: i + width])
            if window in seen:
                gone.update(range(i, i + width))
            seen.add(window)
        out[doc] = (len(w), len(gone), " ".join(v for i, v in enumerate(w) if i not in gone))
    return out


def corpus(seed, n=120):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefgh") + str(rnd.randint(0, 400))
    passages = [[word() for _ in range(rnd.randint(15, 70))] for _ in range(7)] + [["x"] * 60, ["y", "z"] * 25]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rnd.randint(0, 4)):
            p = list(rnd.choice(passages))
            if rnd.random() < 0.4:
                p[rnd.randrange(len(p))] = word()
            a = rnd.randint(0, 10)
            w += p[a: len(p) - rnd.randint(0, 10)] + [word() for _ in range(rnd.randint(0, 25))]
        rows.append((i * 11 % n, rnd.choice([" ", "\n", "\t "]).join(w)))
    return rows


@pytest.mark.parametrize("seed, options", [(0, {}), (1, {"hot": 3}), (2, {"shard": 5}), (3, {"hot": 0})])
def test_random_texts(spark, seed, options):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: tuple(r.found) for r in D.dedup_substrings(df, "found", **options).collect()}
    assert got == brute(rows)


def test_nulls_twins_long_texts_and_clashing_columns(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    schema = "doc_id bigint, text string, k string, gone int"
    rows = [(3, shared, "x", 1), (3, shared, "x", 1), (5, "own " + shared + " end", "x", 1), (None, shared, "x", 1), (1, None, "x", 1), (2, "", "x", 1),
            (9, " ".join(f"w{i % 20000}" for i in range(60_000)), "x", 1)]
    df = spark.createDataFrame(rows, schema)
    out = D.dedup_substrings(df, "found")
    assert out.columns == [*df.columns, "found"]
    got = sorted(((r.doc_id or 0, r.found["n_words"], r.found["n_removed"], r.found["kept"][:9]) for r in out.collect()), key=str)
    assert got == sorted([(3, 60, 0, "s0 s1 s2 "), (3, 60, 0, "s0 s1 s2 "), (5, 62, 60, "own end"), (0, 60, 60, ""), (1, 0, 0, ""), (2, 0, 0, ""),
                          (9, 60_000, 40_000, "w0 w1 w2 ")], key=str)
    assert D.dedup_substrings(df.limit(0), "found").collect() == []


@pytest.mark.parametrize("options", [{}, {"hot": 0}])
def test_null_and_repeated_ids(spark, options):
    p, q = ([f"{x}{i}" for i in range(40)] for x in "pq")
    clean = lambda x: [f"{x}own{i}" for i in range(80)]
    texts = [(1, p), (None, ["start", *p, "end"]), (None, clean("a")), (None, ["begin", *q, "x"]), (None, ["begun", *q, "y"]),
             (4, clean("b")), (4, ["front", *p, "back"])]
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in texts], "doc_id bigint, text string")
    got = {r.text: r.found["kept"] for r in D.dedup_substrings(df, "found", **options).collect()}
    text = [" ".join(w) for _, w in texts]
    assert [got[text[i]] for i in (0, 1, 2, 5, 6)] == [text[0], "start end", text[2], text[5], "front back"]
    assert (got[text[3]], got[text[4]]) in [(text[3], "begun y"), ("begin x", text[4])]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=14), max_size=5), st.lists(st.integers(0, 3), max_size=14))
def test_matching_statistics(references, probe):
    automaton = D.SuffixAutomaton()
    for r in references:
        automaton.add(r)
    subs = {tuple(r[i:j]) for r in references for i in range(len(r)) for j in range(i + 1, len(r) + 1)}
    want = [max((n for n in range(e + 2) if n == 0 or tuple(probe[e + 1 - n: e + 1]) in subs)) for e in range(len(probe))]
    assert list(automaton.matching(probe)) == want


def test_a_phrase_that_one_text_repeats(spark):
    """60,000 segments of one anchor in one document, and a second one with some of them."""
    import pyarrow as pa

    from lakeops.llm import words as W

    rnd = random.Random(4)
    phrases = [f"p{i} is a phrase" for i in range(50_000)]
    w = W.words(pa.array(phrases, pa.large_string()))
    least = phrases[int(W.grams(w.hashes(), D.GRAM)[::4].argmin())]  # the anchor of each window that holds it
    pieces = [f"{least} " + " ".join(f"v{rnd.randint(0, 300)}" for _ in range(12)) for _ in range(60_000)]
    rows = [(1, " ".join(pieces)), (2, "own " + " ".join(pieces[500:700]) + " end"), (3, "nothing of it")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    own = df.selectExpr("doc_id AS k", "xxhash64(text) AS t", "text")
    seen = D.anchors(own, D.WINDOW)
    counts = {r.a: r.n for r in seen.groupBy("a").agg({"c": "sum"}).withColumnRenamed("sum(c)", "n").collect()}
    codes = {r.a: r.code for r in D._folded(seen, D.HOT).collect()}
    assert max(counts.values()) > 50_000 and max((n for a, n in counts.items() if codes.get(a) == 2), default=0) <= D.HOT < D.SHARD
    got = {r.doc_id: tuple(r.found) for r in D.dedup_substrings(df, "found").collect()}
    assert got == brute(rows)
