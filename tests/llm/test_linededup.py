"""Winnowing against a comparison of every window with every earlier one."""

import random
import re

import pytest

from lakeops.llm import linededup as D

BLANK = " \t\n\x0b\f\r"


def brute(rows, width=3, words=50):
    """rows: (doc, text) with distinct ids; what is left, counting lines, lines gone."""
    seen, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = (text or "").split("\n")
        at = [i for i, line in enumerate(lines) if line.strip(BLANK)]
        bare = [lines[i].strip(BLANK) for i in at]
        n = len(bare)
        gone = set()
        size = [len(re.findall(r"[^\x20\x09-\x0D]+", line)) for line in bare]
        for i in range(n):
            for m in range(1, min(width, n - i) + 1):
                if m == width or m == n or sum(size[i: i + m]) >= words:
                    w = tuple(bare[i: i + m])
                    if w in seen:
                        gone.update(range(i, i + m))
                    else:
                        seen[w] = (doc, i)
        cut = {at[c] for c in gone}
        for c in gone:
            if c + 1 in gone:
                cut.update(range(at[c], at[c + 1]))
        left = "\n".join(line for i, line in enumerate(lines) if i not in cut)
        out[doc] = (left if gone else text, n, len(gone))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(spark, seed):
    rnd = random.Random(seed)
    pool = ["a", "b ", "\tc", "", "  ", "d", "long line " * 9, "some\twords  " * 15, "w " * 49, "x\x0b" * 50, "nearly " * 24]
    passages = [[rnd.choice(pool) for _ in range(rnd.randint(2, 7))] for _ in range(6)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randint(0, 5)):
            lines += rnd.choice(passages) if rnd.random() < 0.6 else [rnd.choice(pool), f"own {rnd.randint(0, 9)}"]
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.text, r.n, r.gone) for r in D.dedup_lines(df, counts=("n", "gone")).collect()}
    assert got == brute(rows)


def test_nulls_twins_and_clashing_columns(spark):
    page = "one\ntwo\nthree\nfour"
    schema = "doc_id bigint, text string, hash string, starts int, k string"
    rows = [
        (None, page, "x", 1, "k"), (1, "own\none\n\ntwo\nthree\nfour\nend", "x", 1, "k"), (1, "other\ntext\nof the same id", "x", 1, "k"),
        (2, None, "x", 1, "k"), (3, "", "x", 1, "k"), (4, "own twin\na\nb", "x", 1, "k"), (4, "own twin\na\nb", "x", 1, "k"),
        (5, "own twin\na\nb", "x", 1, "k"), (6, "\n \n", "x", 1, "k")]
    df = spark.createDataFrame(rows, schema)
    got = D.dedup_lines(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([
        (None, page), (1, "own\nend"), (1, rows[2][1]), (2, None), (3, ""), (4, rows[5][1]), (4, rows[5][1]), (5, ""), (6, "\n \n")], key=str)
    kept = D.without_repeated_lines(df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 2, 3, 4, 4, 6]
    assert D.dedup_lines(df.limit(0), counts=("n", "g")).collect() == []


def test_very_long_text_and_one_hot_passage(spark):
    body = [f"line {i}" for i in range(30_000)]
    rows = [(0, "\n".join(body)), (1, "\n".join(["first", *body[100:29_000], "last"]))]
    rows += [(i, f"only {i}\nhot\nhot one\nhot two\nof {i}") for i in range(2, 800)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = {r.doc_id: (r.text, r.n, r.gone) for r in D.dedup_lines(df, counts=("n", "gone")).collect()}
    assert got == brute(rows)
    assert got[1] == ("first\nlast", 28_902, 28_900) and got[799][0] == "only 799\nof 799"


def test_short_windows(spark):
    long, half, other = "w " * 50, " ".join(f"h{i}" for i in range(30)), " ".join(f"o{i}" for i in range(25))
    texts = [
        long.strip(), f"one\n{long}\ntwo", f"{half}\n\n{other}", f"a\nb\n{half}\n{other}\nc\nd", f"{half}\nbetween\n{other}",
        f"x\n{half}\ny", " ".join(["s"] * 49), f"p\n{' '.join(['s'] * 49)}\nq", f"{long}\n{long}\n{long}", "short", "short", "v\nshort\nw"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.text, r.n, r.gone) for r in D.dedup_lines(df, counts=("n", "gone")).collect()}
    assert got == brute(rows)
    assert got[1] == ("one\ntwo", 3, 1) and got[3] == ("a\nb\nc\nd", 6, 2) and got[8] == ("", 3, 3)
    assert all(got[i][2] == 0 for i in (0, 2, 4, 5, 6, 7, 9, 11)) and got[10] == ("", 1, 1)


def test_native_plan(spark, sf):
    plan = D.query(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
