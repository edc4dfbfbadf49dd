"""Fill-in-middle against units counted one by one."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from lakeops.llm import fim, words as W


def brute(key, text):
    """(n, form, prefix characters, middle characters, output)."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i: i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def transformed(rows, summaries=None):
    digests = [hashlib.sha256(f"1:{'' if k is None else k}".encode()).hexdigest() for k, _ in rows]
    column = pa.array([t for _, t in rows], pa.large_string())
    got = fim.transformed(digests, column, fim.PLAIN_FROM, fim.SPM_BELOW, summaries or fim.Summaries())
    return [(*r[:4], r[4].decode()) for r in got]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 999), st.one_of(
    st.none(), st.text(st.characters(codec="utf-8"), max_size=60), st.text("ab é.<PSM>\n", max_size=300))), max_size=8))
def test_any_text(rows):
    assert transformed(rows) == [brute(*r) for r in rows]


LONG = ["a" * 50_000, "é" * 30_000, "ab " * 30_000, "🙂x" * 9_000, "word. " * 3 + "b" * 9_000 + "\n" + "c" * 5_000]


@pytest.mark.parametrize("limit", [2_000, 1 << 20])
def test_long_texts_and_a_small_cache(limit):
    rnd = random.Random(5)
    parts = ["".join(rnd.choice("abc XYZ.,é\n") for _ in range(3_000)) for _ in range(5)]
    rows = list(enumerate([*LONG, *("".join(rnd.sample(parts, 3)) + str(i) for i in range(40))]))
    summaries = fim.Summaries(limit)
    assert transformed(rows, summaries) == [brute(*r) for r in rows]
    assert summaries.size <= max(limit, W.CHUNK_BYTES) + max(map(len, LONG))


def test_shared_passages_are_counted_once():
    rnd = random.Random(3)
    passage = "".join(rnd.choice("abcdefgh ijk.\n") for _ in range(60_000))
    column = pa.array([passage, "own beginning " + passage, passage[777:]], pa.large_string())
    summaries = fim.Summaries()
    texts = fim.Texts(column, summaries)
    assert summaries.found > 0.6 * len(texts.starts)  # two of three come from the cache
    size = np.diff(np.append(texts.starts, len(texts.data)))
    assert size.max() <= fim.MAX_CHUNK and 200 < size.mean() < 1000


def test_chunks_never_split_a_character():
    data, offsets = W.bytes_of(pa.array(["🙂" * 20_000, "", "é" * 9_000], pa.large_string()))
    starts = fim.chunk_starts(data, offsets)
    assert not fim._INSIDE[data[starts]].any() and set(offsets[[0, 2]]) <= set(starts)


def test_query_on_shared_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = {r.doc_id: r for r in fim.query(spark, sf).collect()}
    forms = set()
    for doc_id, text in docs:
        n, form, prefix, middle, output = brute(doc_id, text)
        forms.add(form)
        assert tuple(got[doc_id]) == (doc_id, n, form, prefix, middle, sha(output), sha(text or ""))
    assert forms == {"plain", "psm", "spm"}


def test_nulls_empty_tables_and_clashing_columns(spark):
    schema = "doc_id bigint, text string, n int, output string"
    assert fim.fill_in_middle(spark.createDataFrame([], schema), "made").collect() == []
    rows = [(None, "some words, é and more", 1, "o"), (1, None, 2, "o"), (2, "", 3, "o"), (3, "with <M> in it", 4, "o"),
            (4, "twice the same", 5, "o"), (4, "twice the same", 5, "o"), (5, "<P", 6, "o"), (6, "S>a<", 7, "o")]
    got = fim.fill_in_middle(spark.createDataFrame(rows, schema).coalesce(1), "made")
    assert got.columns == ["doc_id", "text", "n", "output", "made"]
    back = got.withColumn("back", fim.restored(got["made"]["output"], got["made"]["form"])).collect()
    assert [tuple(r)[:4] for r in back] == rows
    assert [tuple(r.made) for r in back] == [brute(r[0], r[1]) for r in rows]
    assert [r.back for r in back] == [r[1] or "" for r in rows]
