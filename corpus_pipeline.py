"""Corpus pipeline: documents to training sequences, one operator a stage.

Each stage works on all that its predecessor kept. Between stages documents are a
written table in the shared folder, so a lost executor costs at most its tasks of one
stage. Columns of ``documents`` go through unchanged, but for ``text`` and ``n_chars``
where lines are cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm import common, decontaminate, langid, linededup, minhash, packing


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or with too few n-grams of a known language, go."""
    return langid.identified(docs, langid.train(langid.learn_from(docs)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines are cut; documents of which nothing else is left go."""
    return linededup.without_repeated_lines(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (shingles of four words, similarity 0.8) the smallest id stays.
    Cut lines make copies less alike, so documents are near duplicates by what is left of
    them or by their whole texts in ``documents``."""
    return minhash.one_of_each(docs, other=common.table(spark, sf_dir, "documents").select("doc_id", "text"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    return decontaminate.without_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4,096 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packed),
]

# Language identification and tokenisation have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return docs
