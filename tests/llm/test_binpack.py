"""Bin completion against all packings, the contract, and the lower bound."""

import functools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from lakeops.llm import binpack as B, tokens


def fewest(sizes, capacity):
    """The least number of bins, by trying all."""

    @functools.cache
    def go(left, rooms):
        if not left:
            return 0
        s, rest = left[0], left[1:]
        best = 1 + go(rest, tuple(sorted((*rooms, capacity - s))))
        for i, room in enumerate(rooms):
            if room >= s and room not in rooms[:i]:
                best = min(best, go(rest, tuple(sorted((*rooms[:i], room - s, *rooms[i + 1:])))))
        return best

    return go(tuple(sorted(sizes, reverse=True)), ())


def histogram(sizes):
    return {s: sizes.count(s) for s in set(sizes)}


def check_plan(plan, counts, capacity):
    used = {}
    for filling, n in plan:
        assert n > 0 and sum(s * each for s, each in filling) <= capacity
        assert [s for s, _ in filling] == sorted({s for s, _ in filling}, reverse=True)
        for s, each in filling:
            used[s] = used.get(s, 0) + each * n
    assert used == {s: n for s, n in counts.items() if n}


@settings(max_examples=250, deadline=None)
@given(st.lists(st.integers(1, 24), min_size=1, max_size=10), st.integers(24, 30))
def test_exact_search_finds_the_fewest(sizes, capacity):
    counts, least = histogram(sizes), fewest(sizes, capacity)
    assert B.lower_bound(counts, capacity) <= least <= sum(n for _, n in B.best_fit(counts, capacity))
    plan, bound = B.complete(counts, capacity, effort=1_000_000, width=0, steps=0)
    check_plan(plan, counts, capacity)
    assert bound <= sum(n for _, n in plan) == least


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 99), st.integers(1, 5_000), max_size=40))
def test_plans_hold_every_piece_and_never_lose_to_best_fit(counts):
    plan, bound = B.complete(counts, 99, effort=50)
    check_plan(plan, counts, 99)
    assert bound <= sum(n for _, n in plan) <= sum(n for _, n in B.best_fit(counts, 99))


def test_search_beats_best_fit():
    sizes = [6, 6, 5, 5, 4, 4, 3, 3, 2, 2] * 3 + [7, 7, 4, 4, 4, 4] * 2
    tries = [(c, sum(n for _, n in B.best_fit(histogram(sizes), c)), sum(n for _, n in B.complete(histogram(sizes), c)[0])) for c in range(7, 21)]
    assert all(b <= a for _, a, b in tries)
    hard = {44: 30, 24: 30, 22: 60, 21: 30, 17: 30, 8: 60, 6: 60}  # best fit wastes here
    fit, found = sum(n for _, n in B.best_fit(hard, 61)), sum(n for _, n in B.complete(hard, 61)[0])
    assert found <= fit


def naive_best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= s]
        room = min(fits) if fits else capacity
        if fits:
            rooms.remove(room)
        rooms.append(room - s)
    return len(rooms)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_best_fit_of_counts_is_best_fit_of_pieces(sizes):
    plan = B.best_fit(histogram(sizes), 50)
    check_plan(plan, histogram(sizes), 50)
    assert sum(n for _, n in plan) == naive_best_fit(sizes, 50)


def plain_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary_path())
    return [[*t.encode(x or "", add_special_tokens=False).ids, B.END] for x in texts]


def check_contract(rows, docs, capacity):
    """rows with ``ids``; docs: (doc_id, text) pairs, which may repeat."""
    want = sorted(
        (k is not None, k or 0, p, a, ids[a: a + capacity])
        for (k, _), ids in zip(docs, plain_ids([t for _, t in docs])) for p, a in enumerate(range(0, len(ids), capacity)))
    got, sequences = [], {}
    for r in rows:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert r.length == len(ids) and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        got.append((r.doc_id is not None, r.doc_id or 0, r.piece, r.start, ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(got) == want
    for s in sequences.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [8, 50, 2048])
def test_pieces_in_sequences(spark, capacity):
    rnd = random.Random(capacity)
    docs = [(i, " ".join(rnd.choice(["word", "some", "é", "long-er", "."]) for _ in range(rnd.randint(0, 60)))) for i in range(120)]
    docs += [(500, None), (501, ""), (None, "without an id"), (None, "nor this"), (7, docs[7][1]), (7, "other text"), (502, "w " * 9_000)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, ids string, length int").repartition(5)
    packed = B.pack(df, capacity=capacity)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    used = check_contract(packed.collect(), docs, capacity)
    lengths = [min(capacity, len(i) - a) for i in plain_ids([t for _, t in docs]) for a in range(0, len(i), capacity)]
    assert B.lower_bound(histogram(lengths), capacity) <= used <= naive_best_fit(lengths, capacity)


def test_query_on_shared_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    one, many = (B.pack(docs.repartition(n)).collect() for n in (1, 64))
    used = check_contract(one, rows, B.CAPACITY)
    place = lambda packed: sorted((r.doc_id, r.piece, r.sequence_id, r.offset) for r in packed)
    assert place(one) == place(many)  # whatever the partitions of the input
    total = sum(r.length for r in one)
    assert used <= 1.01 * total / B.CAPACITY + 1
    assert place(B.query(spark, sf).collect()) == place(one)
    whole = B.assembled(B.pack(docs)).collect()
    assert len(whole) == used and sum(r.n_tokens for r in whole) == total and all(len(r.ids) == 4 * r.n_tokens for r in whole)


def test_empty_table(spark):
    assert B.pack(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_ids_are_not_read_again_unless_asked_for(spark, sf):
    plan = B.query(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ids:binary" not in plan
