"""The permutation is a bijection; shards hold every id once, in the promised places."""

import zlib

import numpy as np
import pytest

from lakeops.llm import tokens, trainorder as O


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4096, 65_537])
def test_permutation(n):
    numbers = np.arange(n)
    a, b = O.Permutation(n, "a")(numbers), O.Permutation(n, "b")(numbers)
    assert sorted(a.tolist()) == list(range(n)) and sorted(b.tolist()) == list(range(n))
    if n >= 1000:
        assert (a != b).mean() > 0.9 and abs(np.corrcoef(numbers, a)[0, 1]) < 0.15
        assert (O.Permutation(n, "a")(numbers) == a).all()


def rebuilt(index, path, **sizes):
    total = len(index)
    by_slot = dict(enumerate(O.read_from(path, 0, total, **sizes)))
    assert len(by_slot) == total
    return by_slot


@pytest.mark.parametrize("length, rows", [(16, 3), (64, 1), (2048, 8192)])
def test_round_trip(spark, sf, tmp_path, length, rows):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).repartition(3).cache()
    path = f"file://{tmp_path}/s"
    index = O.write_shards(docs, path, length=length, shard_rows=rows).collect()
    n = len(index)
    assert sorted(r.slot for r in index) == list(range(n)) == sorted(r.sequence_id for r in index)
    by_slot = rebuilt(index, path, length=length, shard_rows=rows)
    for r in index:
        assert (r.shard, r.byte_offset) == (r.slot // rows, r.slot % rows * length * 2)
        assert zlib.crc32(by_slot[r.slot].tobytes()) == r.ids_crc32
        assert (by_slot[r.slot][r.n_tokens:] == O.PAD).all()
    resumed = list(O.read_from(path, n // 2, n, length=length, shard_rows=rows))
    assert len(resumed) == n - n // 2 and (resumed[0] == by_slot[n // 2]).all()
    # in order of sequences the documents come back whole
    tokenizer = tokens.word_tokeniser(tokens.vocabulary_path())
    want = {r.doc_id: [*[e for e in tokenizer.encode([r.text])[0]], 2] for r in docs.collect()}
    stream = []
    for r in sorted(index, key=lambda r: r.sequence_id):
        begin = len(stream)
        stream += by_slot[r.slot][: r.n_tokens].tolist()
        ends = np.cumsum([len(want[d]) for d in sorted(want)])
        inside = [d for d, e in zip(sorted(want), ends) if e > begin and e - len(want[d]) < len(stream)]
        assert r.doc_ids == inside
    assert stream == [i for d in sorted(want) for i in want[d]]
    assert sorted({r.n_tokens for r in index})[-1] == length and sum(r.n_tokens < length for r in index) <= 1


def test_order_does_not_depend_on_partitions(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.unionByName(docs.filter("doc_id % 7 = 0")).unionByName(docs.limit(30).selectExpr("doc_id", "upper(text) AS text", "lang", "source", "n_chars"))
    found = []
    for n in (3, 64):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            index = O.write_shards(docs.repartition(n), f"file://{tmp_path}/{n}", length=512, shard_rows=300).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
        found.append(sorted((r.slot, r.sequence_id, r.n_tokens, r.ids_crc32, tuple(r.doc_ids)) for r in index))
    assert found[0] == found[1] and len(found[0]) > 300


def test_nulls_repeats_and_empty(spark, tmp_path):
    schema = "doc_id bigint, text string, slot string, docs int"
    rows = [(None, None, "x", 1), (1, "", "x", 1), (1, "", "x", 1), (2, "long " * 30000, "x", 1)]
    docs = spark.createDataFrame(rows, schema).coalesce(1)
    index = O.write_shards(docs, f"file://{tmp_path}/a", length=8, shard_rows=100).collect()
    by_slot = rebuilt(index, f"file://{tmp_path}/a", length=8, shard_rows=100)
    first = min(index, key=lambda r: r.sequence_id)
    assert first.doc_ids == [None, 1, 1, 2] and sorted(r.n_tokens for r in index)[1:] == [8] * (len(index) - 1) and by_slot[first.slot][:3].tolist() == [2, 2, 2]
    assert sum(r.n_tokens for r in index) == 3 + 30_001
    assert O.write_shards(docs.limit(0), f"file://{tmp_path}/b").collect() == []
