"""n-grams and filter counts against plain Python; held-out accuracy."""

import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.llm import langid as L


def plain_grams(text):
    raw = b"  " + bytes(L._READS[b] for b in text.encode()) + b"  "
    return [int.from_bytes(raw[i - 2: i + 3], "little") for i in range(2, len(raw) - 2) if raw[i] != 0x20]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB é9.\nß漢"), max_size=20), min_size=1, max_size=6))
def test_ngrams(texts):
    g = L.ngrams(pa.array(texts, pa.large_string()))
    assert [g.values[a:b].tolist() for a, b in zip(g.offsets[:-1], g.offsets[1:])] == [plain_grams(t) for t in texts]


def test_members_equal_sets_within_the_false_rate():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 1 << 40, 20_000).astype(np.uint64) for _ in range(10)]  # two planes of languages
    model = L.Model.fit([f"l{i}" for i in range(10)], sets, [1] * 10)
    probe = np.concatenate([sets[3][:500], sets[9][:500], rng.integers(0, 1 << 40, 4000).astype(np.uint64)])
    members, total = model.members(L.Grams(probe, np.array([0, len(probe)])))
    want = np.array([np.isin(probe, s).sum() for s in sets])
    assert total.tolist() == [5000] and np.abs(members[0] - want).max() < 15


def test_accuracy_on_held_out_rows(spark, sf):
    big = sf.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "lang", "text")
    got = L.query(spark, big).join(docs, "doc_id")
    for r in got.select("doc_id", "held_out").limit(300).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    share = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.99
    assert got.filter("score < 0 or score > 1").count() == 0


def test_foreign_and_random_texts_are_rejected(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    model = L.train(L.learn_from(docs))
    assert (model.least > 0.2).all() and (model.least < 0.5).all()
    rng = random.Random(1)
    foreign = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        " ".join(f"{rng.getrandbits(64):x}" for _ in range(60)),
        " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(150))]
    probe = spark.createDataFrame([(-i, t, None) for i, t in enumerate(foreign, 1)], docs.schema)
    kept = {r.doc_id for r in L.identified(docs.unionByName(probe), model).select("doc_id").collect()}
    assert not kept & {-1, -2, -3, -4}
    own = [r.doc_id for r in docs.filter(L.held_out(F.col("doc_id"))).collect()]
    assert len(own) > 20 and sum(d in kept for d in own) > 0.97 * len(own)


def test_nulls_ties_and_empty_tables(spark):
    schema = "doc_id bigint, text string, lang string, language string"
    rows = [(i, f"the cat and the dog number {i}", "en", "x") for i in range(1, 40)]
    rows += [(i, f"der hund und die katze nummer {i}", "de", "x") for i in range(40, 60)]
    docs = spark.createDataFrame(rows, schema)
    model = L.train(docs)
    assert model.languages == ["de", "en"]
    probe = spark.createDataFrame([
        (1, None, None, None), (None, "", None, None), (2, "123 .!", None, None), (3, "漢字 漢字", None, None),
        (4, "the dog", None, None), (4, "the dog", None, None), (5, "und der hund " * 30000, None, None), (6, "。、", None, None)], schema)
    got = {(r.doc_id, r.found["lang"]) for r in L.with_language(probe, "found", model).collect()}
    assert got == {(1, "und"), (None, "und"), (2, "und"), (3, "en"), (4, "en"), (5, "de"), (6, "und")}
    kept = L.identified(probe, model)
    assert kept.columns == probe.columns and sorted(r.doc_id for r in kept.collect()) == [4, 4, 5]
    assert L.with_language(docs.limit(0), "found", model).collect() == []
    nothing = L.train(docs.limit(0))
    assert {r.found["lang"] for r in L.with_language(docs, "found", nothing).collect()} == {"und"}
