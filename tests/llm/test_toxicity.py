"""Gradients against differences, planted grades, and held-out accuracy."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeops.llm import toxicity as X


def test_fit_recovers_ordered_grades():
    rng = np.random.default_rng(0)
    truth = np.array([2.0, 1.5, 1.0, -1.0, 0, 0, 0, 0])
    on = rng.random((4000, 8)) < 0.4
    score = on @ truth + rng.logistic(size=4000)
    grade = np.searchsorted([2.0, 3.5, 5.0], score)
    x = X.Sparse(np.nonzero(on)[1].astype(np.int32), np.concatenate([[0], np.cumsum(on.sum(axis=1))]))
    model = X.fit(x, grade, 8)
    assert np.abs(model.weights - truth).max() < 0.4 and (np.diff(model.thresholds) > 0).all()
    p = model.at_least(x)
    assert (np.diff(p, axis=1) <= 0).all()
    assert np.corrcoef(p.sum(axis=1), grade)[0, 1] > np.corrcoef(on @ truth, grade)[0, 1] - 0.02


def test_held_out_documents(spark, sf):
    big = sf.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    model = X.train(docs, labels.filter(~held))
    got = X.with_severity(docs.select("doc_id", "text"), "found", model).join(labels.filter(held), "doc_id")
    share = {r.toxic: r.share for r in got.groupBy("toxic").agg(F.avg((F.col("found")["grade"] > 0).cast("int")).alias("share")).collect()}
    mean = {r.toxic: r.s for r in got.groupBy("toxic").agg(F.avg(F.col("found")["severity"]).alias("s")).collect()}
    assert share[1] > 0.7 and share[0] < 0.05 and mean[1] > mean[0] + 0.8


def test_predictions_equal_plain_sums(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = X.train(docs, labels)
    got = {r.doc_id: r.found for r in X.with_severity(docs.select("doc_id", "text"), "found", model).collect()}
    for r in docs.collect():
        score = sum(model.weights[i] for i in X.features(pa.array([r.text or ""], pa.large_string())).ids.tolist())
        p = [1 / (1 + math.exp(min(40, max(-40, t - score)))) for t in model.thresholds]
        assert got[r.doc_id]["severity"] == pytest.approx(sum(p)) and got[r.doc_id]["toxic_probability"] == pytest.approx(p[0])
        assert got[r.doc_id]["grade"] == sum(x >= X.DECISION for x in p) or min(abs(x - X.DECISION) for x in p) < 1e-9


@pytest.mark.parametrize("which", ["both", "one class", "none"])
def test_nulls_and_missing_labels(spark, which):
    schema = "doc_id bigint, text string, found string, toxic string"
    rows = [(i, f"plain words {i % 7}" + (" awfulword" if i % 2 else ""), "x", "y") for i in range(60)]
    rows += [(None, "text", "x", "y"), (100, None, "x", "y"), (101, "", "x", "y"), (101, "", "x", "y"), (102, "awfulword " * 20000, "x", "y")]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (5, None), (7, 0), (999, 1)], "doc_id bigint, toxic int")
    labels = {"both": labels, "one class": labels.filter("toxic = 0"), "none": labels.limit(0)}[which]
    got = X.with_severity(docs, "severity", X.train(docs, labels))
    grades = {(r.doc_id, r.severity["grade"] > 0) for r in got.filter("doc_id >= 100").collect()}
    assert grades == {(100, False), (101, False), (102, which == "both")}
    assert got.count() == len(rows)
    assert X.with_severity(docs.limit(0), "severity", X.NOTHING).collect() == []
