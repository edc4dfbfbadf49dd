import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.operators import scoring, vectors


def make(spark, n, dim=8, seed=0, copies=0):
    """n random vectors; the first is repeated ``copies`` times under new ids."""
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dim)).astype(np.float32)
    m = np.vstack([m, np.repeat(m[:1], copies, axis=0)])
    data = [(i, [float(x) for x in row], {"text": f"Doc {i}", "g": str(i % 3)}) for i, row in enumerate(m)]
    random.Random(seed).shuffle(data)
    df = spark.createDataFrame(data, "id long, values array<float>, metadata map<string,string>").repartition(5)
    return m.astype(float), df


def brute(q, c, k, metric="cosine", skip_self=False, ids=None):
    out = {}
    for i, a in enumerate(q):
        scored = []
        for j, b in enumerate(c):
            if skip_self and i == j or (ids is not None and j not in ids):
                continue
            if metric == "cosine":
                s = a @ b / np.linalg.norm(a) / np.linalg.norm(b)
            elif metric == "dot":
                s = a @ b
            else:
                s = -np.linalg.norm(a - b)
            scored.append((-round(s, 12), j))
        out[i] = [j for _, j in sorted(scored)[:k]]
    return out


def ranking(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


@pytest.fixture(params=["cells", "blocks"])
def path(request, monkeypatch):
    """Cells of the usual size, and many small ones cut into blocks and tiles."""
    if request.param == "blocks":
        monkeypatch.setattr(vectors, "PIVOTS", 9)
        monkeypatch.setattr(vectors, "TILE_QUERIES", 7)
        monkeypatch.setattr(vectors, "BLOCK_VECTORS", 20)


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_top_k_against_brute_force(spark, path, metric):
    m, df = make(spark, 60, copies=30)  # a third of the corpus is one vector
    out = vectors.vector_top_k(df.withColumnRenamed("id", "query_id"), df, 7, metric)
    assert ranking(out) == brute(m, m, 7, metric)


def test_vectors_of_several_lengths(spark, path):
    queries = [(1, [1.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 2.0, 3.0]), (5, [1.0] * 2000)]
    corpus = [(10, [2.0]), (11, [1.0, 0.1]), (12, [0.1, 1.0]), (13, [5.0] * 2000)]
    frame = lambda r, key: spark.createDataFrame(r, f"{key} bigint, values array<float>")
    out = vectors.vector_top_k(frame(queries, "query_id"), frame(corpus, "id"), 1)
    assert ranking(out) == {1: [10], 2: [11], 3: [12], 5: [13]}


def test_euclidean_threshold_is_the_largest_distance(spark):
    q = spark.createDataFrame([(1, [0.0, 0.0])], "query_id bigint, values array<float>")
    c = spark.createDataFrame([(1, [0.1, 0.0], {}), (2, [4.9, 0.0], {})], "id bigint, values array<float>, metadata map<string,string>")
    assert [r.id for r in vectors.semantic_search(q, c, threshold=1.0, metric="euclidean").collect()] == [1]


def test_k_above_corpus_size(spark, path):
    m, df = make(spark, 5)
    out = vectors.vector_top_k(df.withColumnRenamed("id", "query_id"), df, 50)
    assert ranking(out) == brute(m, m, 50)


def test_find_similar_leaves_itself_out(spark, path):
    m, df = make(spark, 40, copies=10)
    out = vectors.find_similar(df, df.select("id"), 4)
    assert ranking(out) == brute(m, m, 4, skip_self=True)


def test_filter_before_and_threshold_after(spark):
    m, df = make(spark, 50)
    q = df.withColumnRenamed("id", "query_id")
    out = vectors.semantic_search(q, df, k=5, filter={"g": "1"}, threshold=0.3)
    got = ranking(out)
    ids = {j for j in range(50) if j % 3 == 1}
    want = {}
    for i, js in brute(m, m, 5, ids=ids).items():
        kept = [j for j in js if m[i] @ m[j] / np.linalg.norm(m[i]) / np.linalg.norm(m[j]) >= 0.3]
        if kept:
            want[i] = kept
    assert got == want
    assert out.first()["text"].startswith("Doc ")


def test_zero_and_odd_vectors_have_no_score(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0]), (4, None), (5, [2.0, 0.0])], "id long, values array<float>")
    q = spark.createDataFrame([("a", [1.0, 0.0])], "query_id string, values array<float>")
    out = vectors.vector_top_k(q, df, 10)
    assert [(r["id"], r["score"]) for r in out.orderBy("rank").collect()] == [(1, 1.0), (5, 1.0)]
    assert vectors.vector_top_k(q.limit(0), df, 3).count() == 0
    assert vectors.vector_top_k(q, df.limit(0), 3).count() == 0


def test_string_ids(spark):
    df = spark.createDataFrame([("b", [1.0, 0.0]), ("aa", [1.0, 0.0]), ("c", [0.0, 1.0])], "id string, values array<float>")
    out = vectors.vector_top_k(df.withColumnRenamed("id", "query_id"), df, 2)
    assert ranking(out)["c"] == ["c", "aa"]


def test_hybrid_search(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0], {"text": "Apple pie"}), (2, [0.9, 0.1], {"text": "banana"}), (3, [0.0, 1.0], {"text": "APPLE banana"}),
         (4, [-1.0, 0.0], {"x": "no text"})],
        "id long, values array<float>, metadata map<string,string>",
    )
    q = spark.createDataFrame([(1, [1.0, 0.0], ["apple", "Banana"]), (2, [1.0, 0.0], [])], "query_id long, values array<float>, keywords array<string>")
    out = vectors.hybrid_search(q, df, k=2, semantic_weight=0.5)
    got = {(r["query_id"], r["rank"]): (r["id"], r["keyword_score"], r["total_results"]) for r in out.collect()}
    assert got == {(1, 1): (1, 0.5, 4), (1, 2): (2, 0.5, 4), (2, 1): (1, 0.0, 4), (2, 2): (2, 0.0, 4)}


def test_rag_context(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], {"text": "one"}), (2, [0.6, 0.8], {"text": "two"})], "id long, values array<float>, metadata map<string,string>")
    q = spark.createDataFrame([(7, [1.0, 0.0])], "query_id long, values array<float>")
    assert vectors.rag_context(q, df, 3).first()["context"] == (
        "[Document 1] (Similarity: 1.000)\none\n\n[Document 2] (Similarity: 0.600)\ntwo"
    )


def test_upsert(spark):
    ddl = "id string, values array<float>, metadata map<string,string>"
    target = spark.createDataFrame([("a", [1.0], {"text": "old"}), ("b", [2.0], {"text": "kept"})], ddl)
    items = spark.createDataFrame(
        [("a", "new", [3.0], {"text": "mine", "k": "v"}), ("", "x", [1.0], None), ("c", "", [1.0], None), (None, "x", [1.0], None),
         ("d", "plain", [4.0], None)],
        "id string, text string, values array<float>, metadata map<string,string>",
    )
    got = {r["id"]: r["metadata"] for r in vectors.upsert_vectors(target, items, "m", "now").collect()}
    assert set(got) == {"a", "b", "d"}
    assert got["a"] == {"text": "mine", "model": "m", "created_at": "now", "k": "v"}
    assert got["d"] == {"text": "plain", "model": "m", "created_at": "now"}
    assert tuple(vectors.index_stats(target).first()) == (1, 2)


def test_plan_has_no_cross_join(spark):
    _, df = make(spark, 30)
    out = vectors.vector_top_k(df.withColumnRenamed("id", "query_id"), df, 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("hashpartitioning(") == 3  # visits, visited cells, candidates


def test_forest(spark):
    rng = random.Random(1)
    data = [(i, [rng.random() + (i % 2), rng.random()], "odd" if i % 2 else "even") for i in range(200)]
    df = spark.createDataFrame(data, "id long, f array<float>, label string")
    model = scoring.train_forest(df, "f", "label", trees=10)
    out = scoring.score(model, df.drop("label"), ["id"], "f", "v1").collect()
    assert sum((r["prediction"] == "odd") == bool(r["id"] % 2) for r in out) > 190
    assert all(0.5 <= r["probability"] <= 1 and r["model_version"] == "v1" for r in out)
    wide = df.select("id", F.col("f")[0].alias("a"), F.col("f")[1].alias("b"), "label")
    model = scoring.train_forest(wide, ["a", "b"], "label", trees=5)
    assert scoring.score(model, wide, ["id"], ["a", "b"], "v2").count() == 200


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_cells_that_can_not_win_are_not_visited(spark, monkeypatch, metric):
    if metric not in vectors.METRICS:
        pytest.skip("no such metric")
    monkeypatch.setattr(vectors, "PIVOTS", 30)
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(12, 8)) * 10
    data = np.concatenate([c + rng.normal(size=(60, 8)) * 0.2 for c in centers]).astype(np.float32)
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id bigint, values array<float>").repartition(4)
    picked = range(0, 720, 7)
    queries = spark.createDataFrame([(i, data[i].tolist()) for i in picked], "query_id bigint, values array<float>")
    got = {}
    for r in vectors.vector_top_k(queries, corpus, 4, metric).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id))
    wide = data.astype(np.float64)
    for i in picked:
        if metric == "euclidean":
            score = -np.round(np.sqrt(((wide - wide[i]) ** 2).sum(axis=1)), 12)
        else:
            score = wide @ wide[i]
            if metric == "cosine":
                score = score / (np.sqrt((wide**2).sum(axis=1)) * np.sqrt((wide[i] ** 2).sum()))
            score = np.round(score, 12)
        assert [d for _, d in sorted(got[i])] == np.lexsort((np.arange(720), -score))[:4].tolist()
    seen = vectors.pairs_compared(queries, corpus, 4, metric).first()
    assert seen.all_pairs == 720 * len(picked) and seen.pairs < (0.5 if metric != "dot" else 0.9) * seen.all_pairs


def test_a_query_is_sent_to_sectors_not_to_cells(spark):
    _, df = make(spark, 400, copies=20)
    q = df.withColumnRenamed("id", "query_id")
    _, visits, cells = vectors._search(q, df, 3, "cosine")
    for step in visits:
        assert step.count() == 420  # one row per query, whatever it visits
        met = step.select(F.explode("sectors").alias("s")).agg(F.max("s"), F.count("*")).first()
        assert met[0] < vectors.SECTORS < len(cells.stats) and met[1] <= 420 * vectors.SECTORS
    seen = vectors.pairs_compared(q, df, 3).first()
    assert 0 < seen.pairs <= seen.all_pairs == 420 * 420


def test_sectors_hold_about_as_many_vectors():
    sizes = {c: 100 + c for c in range(64)}
    of = vectors._sectors(sizes, np.random.default_rng(0).normal(size=(64, 4)))
    held = [sum(n for c, n in sizes.items() if of[c] == s) for s in range(vectors.SECTORS)]
    each = sum(sizes.values()) / vectors.SECTORS
    assert set(of) == set(sizes) and max(held) <= each + max(sizes.values())
    assert vectors._sectors({7: 5}, None) == {7: 0}


def best_of(q, c, ids, k, metric, floor=-np.inf):
    best = vectors._Best(q, k, metric, np.full(len(q), floor))
    for lo in range(0, len(c), 100):
        best.add(np.arange(len(q)), ids[lo: lo + 100], c[lo: lo + 100])
    best._merge()
    return [best.ids[best.owner == i].tolist() for i in range(len(q))]


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
@pytest.mark.parametrize("kind", ["plain", "near", "offset", "far", "tiny", "same", "odd"])
def test_scores_of_single_precision_lose_nothing(kind, metric):
    rng = np.random.default_rng(1)
    for dim in (1, 3, 64):
        c, q, ids = rng.normal(size=(250, dim)), rng.normal(size=(60, dim)), rng.permutation(250)
        if kind == "near":
            c = c[:1] + c * 1e-7
            q = c[:60]
        elif kind == "offset":
            c = 1e6 + c * 1e-3
            q = c[:60] + 1e-4 * q
        elif kind == "far":
            c[::50] *= 1e9
            q[::9] *= 1e8
        elif kind == "tiny":
            c, q = c * 1e-9, q * 1e-6
        elif kind == "same":
            c[20:200] = q[::4] = c[20]
        elif kind == "odd":
            c[5], c[6], c[7, 0], c[8], c[30:33] = 0, np.nan, np.inf, 1e200, 0
            q[3], q[4], q[5, 0], q[6] = 0, np.nan, -np.inf, 1e200
        for k in (1, 7, 300):
            got = best_of(q, c, ids, k, metric)
            with np.errstate(all="ignore"):
                for i, a in enumerate(q):
                    if metric == "euclidean":
                        s = -np.sqrt(((c - a) ** 2).sum(axis=1))
                    else:
                        s = np.array([np.einsum("i,i->", a, x) for x in c])
                        if metric == "cosine":
                            s /= np.sqrt(np.einsum("i,i->", a, a)) * np.sqrt(np.einsum("ij,ij->i", c, c))
                    s = np.nan_to_num(np.round(s, 12), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                    want = [ids[j] for j in np.lexsort((ids, -s)) if s[j] > -np.inf][:k]
                    assert got[i] == want, (dim, k, i)


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_few_pairs_get_a_score_in_double_precision(monkeypatch, metric):
    seen = []
    scores = vectors._Best._scores
    monkeypatch.setattr(vectors._Best, "_scores", lambda self, *a: (seen.append((out := scores(self, *a)).size), out)[1])
    rng = np.random.default_rng(3)
    c = rng.normal(size=(3000, 16))
    best_of(c[:200], c, np.arange(3000), 5, metric)
    assert sum(seen) < 0.1 * 200 * 3000


def test_hybrid_search_sorts_no_texts(spark):
    _, df = make(spark, 20)
    q = df.select(F.col("id").alias("query_id"), "values", F.array(F.lit("doc")).alias("keywords"))
    plan = vectors.hybrid_search(q, df, k=3)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    windows = [i for i, line in enumerate(plan) if "Window [" in line]
    assert windows
    for i in windows:
        below = next(line for line in plan[i + 1:] if "Project [" in line)
        assert "text#" not in below.split("Project [")[1] and "metadata#" not in below


def test_hybrid_search_with_ids_of_several_texts(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0], {"text": "apple"}), (1, [1.0, 0.0], {"text": "pear"}), (2, [0.0, 1.0], {"x": ""}), (2, [0.0, 1.0], {"text": ""})],
        "id long, values array<float>, metadata map<string,string>")
    q = spark.createDataFrame([(1, [1.0, 0.0], ["apple"])], "query_id long, values array<float>, keywords array<string>")
    got = [(r["id"], r["keyword_score"], r["text"]) for r in vectors.hybrid_search(q, df, k=10).orderBy("rank").collect()]
    # two vectors and two texts of each id, as a join on the id has them
    assert sorted(got, key=str) == sorted([(1, 1.0, "apple")] * 2 + [(1, 0.0, "pear")] * 2 + [(2, 0.0, None)] * 2 + [(2, 0.0, "")] * 2, key=str)


def test_find_similar_where_an_id_has_many_vectors(spark, path):
    m, _ = make(spark, 60)
    data = [(i, [float(x) for x in row]) for i, row in enumerate(m)] + [(7, [float(x) for x in m[7]])] * 9
    df = spark.createDataFrame(data, "id long, values array<float>").repartition(3)
    got = {}
    for r in vectors.find_similar(df, df.select("id"), 4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"]))
    every = np.array([v for _, v in data]).astype(np.float32).astype(float)
    unit = every / np.linalg.norm(every, axis=1)[:, None]
    for i in range(60):
        pairs = sorted((-round(a @ b, 12), j) for a, (x, _) in zip(unit, data) if x == i for b, (j, _) in zip(unit, data) if j != i)
        assert [j for _, j in sorted(got[i])] == [j for _, j in pairs[:4]]
