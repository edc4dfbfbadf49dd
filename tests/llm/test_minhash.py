"""Classes against all pairs; the second step alone; edges of the contract."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lakeops.llm import graph, minhash as M


def brute(rows, k=4, percent=80):
    """rows: (id, text) with distinct ids; id -> (set size, component)."""
    sets = {}
    for d, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[d] = {tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {d: (len(sets[d]), find(d)) for d in ids}


def corpus(seed, n=150):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randint(0, 3000)}"
    bases = [[word() for _ in range(rnd.randint(1, 120))] for _ in range(8)]
    rows = []
    for i in range(n):
        w = list(rnd.choice(bases)) if rnd.random() < 0.8 else [word() for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 7)):
            if w:
                w[rnd.randrange(len(w))] = word()
        rows.append((i * 7 % n, rnd.choice(["  ", " ", "\n"]).join(w) if w else rnd.choice([None, "", " \t"])))
    return rows


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("seed", [0, 1])
def test_classes_equal_all_pairs(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = M.near_duplicates(df)
    assert result(got) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_prefixes_find_what_stars_leave(spark, monkeypatch):
    rows = corpus(3)
    monkeypatch.setattr(M, "confirmed", lambda pairs, texts, **o: pairs.filter("false"))  # the stars find nothing
    monkeypatch.setattr(M, "BLOCK", 5)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(M.near_duplicates(df)) == brute(rows)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(5)
    for share in (0.3, 0.6, 0.9):
        x = rng.integers(0, 1 << 63, 9000).astype(np.uint64)
        cut = int(len(x) * (1 - share) / 2)
        a, b = M.signature(np.sort(x[cut:])), M.signature(np.sort(x[: len(x) - cut]))
        assert abs((a == b).mean() - (len(x) - 2 * cut) / len(x)) < 0.12


def test_bands_rarely_miss():
    rng = np.random.default_rng(6)
    found = 0
    for _ in range(200):
        x = rng.integers(0, 1 << 63, 180).astype(np.uint64)
        a, b = M.bands(M.signature(x[:162])), M.bands(M.signature(x[18:]))  # 144 of 180 in common
        found += (a == b).any()
    assert found == 200


def test_nulls_twins_clashing_columns_and_empty(spark):
    text = " ".join(f"word{i}" for i in range(60))
    schema = "doc_id bigint, text string, c string, gone int, n string"
    rows = [(5, text, "x", 1, "y"), (5, text, "x", 1, "y"), (7, text.upper(), "x", 1, "y"), (None, text, "x", 1, "y"), (1, None, "x", 1, "y"),
            (2, "", "x", 1, "y"), (3, "one two", "x", 1, "y"), (4, "One  two", "x", 1, "y"), (6, "far " * 50000, "x", 1, "y"), (8, "word1 other", "x", 1, "y")]
    df = spark.createDataFrame(rows, schema)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 57, 5, True), (5, 57, 5, True), (7, 57, 5, False), (None, 57, 5, False), (1, 0, 1, True), (2, 0, 2, True),
                          (3, 1, 3, True), (4, 1, 3, False), (6, 1, 6, True), (8, 1, 8, True)], key=str)
    kept = M.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [1, 2, 3, 5, 5, 6, 8]
    assert M.near_duplicates(df.limit(0)).collect() == []


def test_null_and_repeated_ids(spark):
    a, b, c = ([f"{x}{i}" for i in range(100)] for x in "abc")
    near = lambda w, i: " ".join([*w[:i], "other", *w[i + 1:]])
    texts = [(None, near(a, 1)), (None, near(a, 50)), (7, near(b, 3)), (7, near(c, 3)), (8, near(b, 60)), (9, near(c, 60)), (None, "quite another text"), (None, near(c, 80))]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in M.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, None, True), (None, None, False), (7, 7, True), (7, 7, True), (8, 7, False), (9, 7, False),
                          (None, None, True), (None, 7, False)], key=str)
    kept = [(r.doc_id, r.text) for r in M.one_of_each(df).collect()]
    assert len(kept) == 4 and set(kept) >= {texts[2], texts[3], texts[6]} and len(set(kept) & set(texts[:2])) == 1


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(6, 60)] + [(rnd.randint(200, 400), rnd.randint(200, 400)) for _ in range(120)] + [(9, 9)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {x: x for e in edges for x in e}
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in edges:
        ra, rb = sorted((find(a), find(b)))
        root[rb] = ra
    assert {x: c for x, c in got.items()} == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}


def test_versions_link_documents(spark):
    rnd = random.Random(8)
    base = [f"w{rnd.randint(0, 9999)}" for _ in range(100)]
    near = [*base[:96], "other", *base[97:]]
    text = " ".join
    now = [(1, text(base[:30])), (2, text(near[40:])), (3, "alone with its own words"), (4, text(base[:30])), (5, "alone too, nothing else here"),
           (None, "no id"), (6, "twice in the other table"), (7, None)]
    whole = [(1, text(base)), (2, text(near)), (3, "alone with its own words"), (5, "a longer version of five"), (5, "and another one"),
             (6, text(base)), (6, text(near)), (8, text(base)), (None, text(base)), (7, text(near))]
    df, other = (spark.createDataFrame(x, "doc_id bigint, text string").repartition(3) for x in (now, whole))
    one = M.one_of_each(df, other=other)
    # 1 and 2 by their whole texts, 4 and 1 by what is left of them; a null text of 7 keeps its row
    assert sorted(r.doc_id or 0 for r in one.collect()) == [0, 1, 3, 5, 6, 7]
    assert sorted(r.doc_id or 0 for r in M.one_of_each(df).collect()) == [0, 1, 2, 3, 5, 6, 7]
