"""Model training and batch scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from lakeops.session import scratch_dir

TREES = 100


def _features(df: DataFrame, features: str | Sequence[str]) -> tuple[DataFrame, list]:
    """An array column becomes a vector; several numeric columns are assembled."""
    if isinstance(features, str):
        return df.withColumn("features", array_to_vector(F.col(features).cast("array<double>"))), []
    return df, [VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")]


def train_forest(
    df: DataFrame, features: str | Sequence[str], label: str, trees: int = TREES, seed: int = 42,
    max_depth: int = 5,
) -> PipelineModel:
    """Random forest over an array column or several numeric columns."""
    data, stages = _features(df, features)
    labels = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="_label", numTrees=trees, seed=seed, maxDepth=max_depth
    )
    fitted = Pipeline(stages=[*stages, labels, forest]).fit(data)
    # A saved model has no training summary. That of a fitted one refers to the session,
    # which can't be sent to tasks any more once an observation was made in it.
    path = scratch_dir(df.sparkSession, "forest")
    fitted.write().save(path)
    return PipelineModel.load(path)


def score(
    model: PipelineModel, df: DataFrame, keys: Sequence[str], features: str | Sequence[str], version: str
) -> DataFrame:
    """``keys, prediction`` (the label text), ``probability`` of it, ``model_version``.

    Scoring is a row-wise transform; rows need no label.
    """
    data, _ = _features(df, features)
    names = model.stages[-2].labelsArray[0]
    for stage in model.stages[:-2] + model.stages[-1:]:
        data = stage.transform(data)
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("prediction").cast("int") + 1)
    return data.select(
        *keys,
        label.alias("prediction"),
        F.array_max(vector_to_array("probability")).alias("probability"),
        F.lit(version).alias("model_version"),
    )
