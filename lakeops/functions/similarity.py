"""Similarity of two vector columns as native expressions (row-wise use)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

METRICS = ("cosine", "dot", "euclidean")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def similarity(a: Column, b: Column, metric: str = "cosine") -> Column:
    """Cosine or dot score, or euclidean distance.

    Vectors of different lengths give NULL (the padded products are NULL);
    a zero vector has no cosine and gives NULL.
    """
    if metric == "dot":
        return dot(a, b)
    if metric == "cosine":
        return F.try_divide(dot(a, b), norm(a) * norm(b))
    if metric == "euclidean":
        squares = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, p: acc + p))
    raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")
