"""Vector search: every embedding is a query against all embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.bindings.base import query, rounded, table
from lakeops.functions.similarity import similarity
from lakeops.operators import scoring, vectors


def corpus(spark, sf):
    """Embeddings with the document text of the same id as metadata."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    label = F.col("label").cast("string")
    return table(spark, sf, "embeddings").join(docs, "vec_id", "left").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").alias("values"),
        F.create_map(F.lit("text"), F.coalesce("text", F.lit("")), F.lit("label"), label).alias("metadata"),
    )


def plain(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("values"))


def questions(spark, sf):
    return plain(spark, sf).withColumnRenamed("id", "query_id")


_COSINE = "round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 12)"


def ranked_sql(k: int, where: str = "true", score: str = _COSINE) -> str:
    return f"""SELECT q.vec_id AS query_id, c.vec_id AS id, {score} AS score,
                      row_number() OVER (PARTITION BY q.vec_id ORDER BY {score} DESC, c.vec_id) AS rank
               FROM embeddings q, embeddings c WHERE {where} QUALIFY rank <= {k}"""


_TEXT = "LEFT JOIN documents d ON d.doc_id = r.id"


@query("j2_vector_top_k", f"SELECT query_id, id, round(score, 6) AS score, rank::INTEGER AS rank FROM ({ranked_sql(10)})")
def _(spark, sf):
    return rounded(vectors.vector_top_k(questions(spark, sf), plain(spark, sf), 10), score=6)


@query(
    "v2_similarity",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine,
              round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS dot,
              round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS euclidean
       FROM lineitem JOIN embeddings a ON a.vec_id = l_partkey JOIN embeddings b ON b.vec_id = l_suppkey""",
)
def _(spark, sf):
    """Pairs named by two equi-joins: the vectors of a line's part and supplier."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    side = lambda key, out: plain(spark, sf).select(F.col("id").alias(key), F.col("values").alias(out))
    joined = lines.join(side("l_partkey", "a"), "l_partkey").join(side("l_suppkey", "b"), "l_suppkey")
    metric = lambda m: F.round(similarity(F.col("a"), F.col("b"), m), 6).alias(m)
    return joined.select(*lines.columns, metric("cosine"), metric("dot"), metric("euclidean"))


@query(
    "v3_semantic_search",
    f"""SELECT query_id, rank::INTEGER AS rank, r.id, round(score, 6) AS score, coalesce(d.text, '') AS text
        FROM ({ranked_sql(10, "c.label = 3")}) r {_TEXT} WHERE score >= 0.1""",
)
def _(spark, sf):
    out = vectors.semantic_search(
        questions(spark, sf), corpus(spark, sf), k=10, filter={"label": "3"}, threshold=0.1
    )
    return rounded(out.select("query_id", "rank", "id", "score", "text"), score=6)


@query(
    "v3_euclidean_top_k",
    f"""SELECT query_id, id, round(-score, 6) AS score, rank::INTEGER AS rank FROM (
        {ranked_sql(5, score="round(-list_distance(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 12)")})""",
)
def _(spark, sf):
    out = vectors.vector_top_k(questions(spark, sf), plain(spark, sf), 5, "euclidean")
    return rounded(out, score=6)


_KEYWORDS = ("the", "der", "eau", "THAT")


@query(
    "v4_hybrid_search",
    f"""WITH s AS (SELECT query_id, r.id, score, coalesce(d.text, '') AS text,
                          ({" + ".join(f"contains(lower(coalesce(d.text, '')), '{w.lower()}')::INTEGER" for w in _KEYWORDS)}) / {len(_KEYWORDS)} AS kw
                   FROM ({ranked_sql(20)}) r {_TEXT}),
        h AS (SELECT *, round(score * 0.7 + kw * (1 - 0.7), 12) AS hs, count(*) OVER (PARTITION BY query_id) AS total_results FROM s)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY hs DESC, id)::INTEGER AS rank, id,
               round(hs, 6) AS hybrid_score, round(score, 6) AS semantic_score, kw AS keyword_score, text, total_results
        FROM h QUALIFY rank <= 10""",
)
def _(spark, sf):
    q = questions(spark, sf).withColumn("keywords", F.array(*[F.lit(w) for w in _KEYWORDS]))
    return rounded(vectors.hybrid_search(q, corpus(spark, sf)), hybrid_score=6, semantic_score=6)


@query(
    "v5_find_similar",
    f"SELECT query_id, id, round(score, 6) AS score, rank::INTEGER AS rank FROM ({ranked_sql(5, 'q.vec_id <> c.vec_id')})",
)
def _(spark, sf):
    c = plain(spark, sf)
    return rounded(vectors.find_similar(c, c.select("id")), score=6)


@query(
    "v6_rag_context",
    f"""SELECT query_id, count(*) AS documents,
               string_agg('[Document ' || rank || '] (Similarity: ' || printf('%.3f', score) || ')' || chr(10) || coalesce(d.text, ''),
                          chr(10) || chr(10) ORDER BY rank) AS context
        FROM ({ranked_sql(3)}) r {_TEXT} GROUP BY 1""",
)
def _(spark, sf):
    return vectors.rag_context(questions(spark, sf), corpus(spark, sf))


@query(
    "v1_upsert_vectors",
    """SELECT coalesce(d.doc_id, e.vec_id) AS id, CASE WHEN d.doc_id IS NULL THEN e.label::VARCHAR ELSE d.lang END AS tag,
              CASE WHEN d.doc_id IS NULL THEN 64 ELSE 2 END AS dimension,
              CASE WHEN d.doc_id IS NULL THEN NULL ELSE 'm1' END AS model
       FROM embeddings e FULL JOIN (SELECT * FROM documents WHERE text <> '') d ON d.doc_id = e.vec_id""",
)
def _(spark, sf):
    target = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("values"),
        F.create_map(F.lit("tag"), F.col("label").cast("string")).alias("metadata"),
    )
    items = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), "text", F.array(F.col("n_chars").cast("float"), F.lit(1.0)).alias("values"),
        F.create_map(F.lit("tag"), F.col("lang")).alias("metadata"),
    )
    out = vectors.upsert_vectors(target, items, "m1", "2024-01-31")
    at = lambda k: F.try_element_at("metadata", F.lit(k))
    return out.select("id", at("tag").alias("tag"), F.size("values").alias("dimension"), at("model").alias("model"))


@query("v7_index_stats", "SELECT max(len(embedding))::INTEGER AS dimension, count(*) AS vector_count FROM embeddings")
def _(spark, sf):
    return vectors.index_stats(plain(spark, sf))


@query("v8_train_and_score")
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    model = scoring.train_forest(e, "embedding", "label")
    return scoring.score(model, e, ["vec_id"], "embedding", "v1")


@query(
    "v8_scores_hold",
    """SELECT count(*) AS rows, count(DISTINCT vec_id) AS ids, count(*) AS likely, (SELECT max(n) FROM (SELECT count(*) AS n FROM embeddings GROUP BY label)) AS majority,
              true AS beats_majority FROM embeddings""",
)
def _(spark, sf):
    """Every vector is scored once, with a probability over that of chance, and more of
    them rightly than the most frequent label would be."""
    e = table(spark, sf, "embeddings")
    scored = scoring.score(scoring.train_forest(e, "embedding", "label"), e, ["vec_id"], "embedding", "v1")
    labels = e.groupBy("label").count()
    most, kinds = labels.agg(F.max("count"), F.count("*")).first()
    right = F.col("prediction") == F.col("label").cast("string")
    return scored.join(e.select("vec_id", "label"), "vec_id").agg(
        F.count("*").alias("rows"), F.countDistinct("vec_id").alias("ids"),
        F.count_if(F.col("probability").between(1 / kinds - 1e-9, 1 + 1e-9)).alias("likely"), F.lit(most).alias("majority"),
        (F.count_if(right) > most).alias("beats_majority"))
