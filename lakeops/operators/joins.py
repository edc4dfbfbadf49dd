"""Equi-joins. The join strategy is left to Catalyst and AQE (broadcast by
measured size, skewed partitions split)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakeops.functions.timeparts import Moment, instant


def enrich(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "") -> DataFrame:
    """Left join that keeps every left row; right columns optionally prefixed."""
    renamed = right.withColumnsRenamed({c: prefix + c for c in right.columns if c not in keys})
    return left.join(renamed, list(keys), "left")


def lookup_by_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is asked for (each row once)."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def missing_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Asked-for keys that ``df`` does not have."""
    return ids.select(key).distinct().join(df.select(key), key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (referential integrity)."""
    return child.filter(F.col(child_key).isNotNull()).join(
        parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti"
    )


def referential_integrity(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """One row: ``element_count, unexpected_count, success``.

    Keys are counted before the join, so a hot foreign key joins once.
    """
    counted = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(
        F.count("*").alias("_n")
    )
    known = parent.select(F.col(parent_key).alias(child_key)).distinct().withColumn("_known", F.lit(True))
    return (
        counted.join(known, child_key, "left")
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("element_count"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).alias(
                "unexpected_count"
            ),
        )
        .withColumn("success", F.col("unexpected_count") == 0)
    )


def resolve_tokens(
    df: DataFrame, vault: DataFrame, token_col: str, as_of: Moment, out: str = "original"
) -> DataFrame:
    """Token -> original value; expired and unknown tokens give NULL."""
    alive = vault.filter(F.col("expires_at").cast("timestamp_ntz") > instant(as_of)).select(
        F.col("token").alias(token_col), F.col("value").alias(out)
    )
    return df.join(alive, token_col, "left")
