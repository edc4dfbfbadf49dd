"""Token ids against the tokenizer itself; packing against its contract and brute force."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from lakeops.llm import packing, tokens

PATH = tokens.vocabulary_path()


def plain_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


AWKWARD = [
    "", None, " ", "It's the end. Isn't it?", "A--b...c!! (x)_y 3.14", "<|endoftext|> a<|startoftext|>b", "é. »x« “q”.",
    "été.  nbsp em", "l'été d'or 'tis o'clock's", "日本語。テキスト 12３", "x" * 3000, "a.b.c.d\n\ne\tf\r\ng",
    "ΟΔΟΣ Σ. ΑΣ'", "\x00\x01\x1c\x1f a", "don't.'s '.' ''", "İstanbul ǅ", "tab\x0bvt\x0cff", "🙂🙃 a🙂.b",
]


def test_ids_equal_the_tokenizer():
    texts = AWKWARD * 3
    got = [ids.tolist() for _, ids, _ in tokens.token_rows(pa.array(texts), PATH, None)]
    assert got == plain_ids(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=8))
def test_ids_of_any_text(texts):
    got = [ids.tolist() for _, ids, _ in tokens.token_rows(pa.array(texts), PATH, None)]
    assert got == plain_ids(texts)


def test_shared_tables(spark, sf):
    texts = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    got = [ids.tolist() for _, ids, _ in tokens.token_rows(pa.array(texts), PATH, None)]
    assert got == plain_ids(texts)


@given(
    st.lists(st.tuples(st.integers(1, 7), st.integers(0, 9)), min_size=1, max_size=9), st.integers(7, 15))
def test_cuts_cost_the_least(steps, limit):
    positions = [0, *itertools.accumulate(s for s, _ in steps)]
    penalties = [0, *(p for _, p in steps)]
    n = len(positions)

    def cost(cuts):
        total, before = 0, 0
        for j in cuts:
            if positions[j] - positions[before] > limit:
                return None
            total += penalties[j] + limit - (positions[j] - positions[before])
            before = j
        return total

    options = (
        cost([*inner, n - 1]) for k in range(n) for inner in itertools.combinations(range(1, n - 1), k))
    assert cost(packing.least_cost_cuts(positions, penalties, limit)) == min(c for c in options if c is not None)
    ends = [i for i in range(n) if positions[-1] - positions[i] <= limit]
    options = [cost([*inner, i] if i else []) for i in ends for k in range(max(i, 1)) for inner in itertools.combinations(range(1, i), k)]
    assert cost(packing.least_cost_cuts(positions, penalties, limit, True)) == min(c for c in options if c is not None)


def check_contract(rows, texts, limit):
    """rows: (doc, start, length, ids, doc_tokens, sequence, offset, padded)."""
    want = {d: [*ids, 2] for d, ids in zip(texts, plain_ids(texts.values()))}
    pieces, sequences = {}, {}
    for d, start, length, ids, total, seq, offset, padded in rows:
        ids = np.frombuffer(ids, dtype="<u4").tolist()
        assert len(ids) == length > 0 and total == len(want[d])
        pieces.setdefault(d, []).append((start, ids))
        sequences.setdefault(seq, []).append((offset, length, padded))
    assert {d: [i for _, ids in sorted(p) for i in ids] for d, p in pieces.items()} == want
    for p in pieces.values():
        assert all(a + len(i) == b for (a, i), (b, _) in itertools.pairwise(sorted(p)))
    for s in sequences.values():
        end = 0
        for offset, length, _ in sorted(s):
            assert offset == end
            end += length
        assert end <= limit and {x[2] for x in s} == {end if end & (end - 1) == 0 else limit}


@pytest.mark.parametrize("limit, stretch", [(16, 2), (64, 3), (4096, 64)])
def test_every_id_once(spark, limit, stretch):
    texts = dict(enumerate(AWKWARD))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = packing.pack(df.coalesce(1), max_tokens=limit, stretch=stretch, free_gap=5).collect()
    cols = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_length")
    check_contract([tuple(r[c] for c in cols) for r in got], texts, limit)


def test_query_on_shared_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    cols = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_length")
    got = packing.pack(docs).select(*cols).collect()
    check_contract([tuple(r) for r in got], texts, 4096)
    tokens_, room = sum(r.length for r in got), sum({r.sequence_id: r.padded_length for r in got}.values())
    assert room - tokens_ < 0.02 * room + 4096
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in packing.query(spark, sf).collect()}
    assert crc == {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in got}


def test_padding_does_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    cols = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_length")
    share = []
    for n in (3, 64):
        got = packing.pack(docs.repartition(n), max_tokens=512).select(*cols).collect()
        check_contract([tuple(r) for r in got], texts, 512)
        share.append(sum(r.length for r in got) / sum({r.sequence_id: r.padded_length for r in got}.values()))
    assert abs(share[0] - share[1]) < 0.01 and min(share) > 0.93  # a cut sentence costs as much as 32 ids


def test_nulls_empty_tables_and_clashing_columns(spark):
    schema = "doc_id bigint, text string, sequence_id string, ids int, part int, tail string"
    assert packing.pack(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, None, "s", 1, 1, "t"), (1, "", "s", 2, 1, "t"), (1, "", "s", 2, 1, "t")]
    got = packing.pack(spark.createDataFrame(rows, schema).coalesce(1)).collect()
    assert [(r.doc_id, r.length, r.doc_tokens) for r in got] == [(None, 1, 1), (1, 1, 1), (1, 1, 1)]
