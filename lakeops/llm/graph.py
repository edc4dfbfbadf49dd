"""Connected components of an edge table, in tables of the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeops.llm import common


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for each node of ``edges``: two
    bigint columns, in any direction, repeats allowed.

    Large-star and small-star steps (Kiveris et al., 2014) alternate until the edges
    are stars. Both fold each node's neighbours to their minimum before they join, so a
    node of any degree is one row there, and AQE splits the other side.
    """
    a, b = edges.columns
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    now, before = common.written(now, "edges"), None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 999_983)).first()
        if seen == before or seen[0] == 0:
            break
        before = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = common.written(low.select("u", F.col("m").alias("v")).unionByName(rest).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
