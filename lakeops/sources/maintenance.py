"""Retention of date-partitioned layers."""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.functions.timeparts import Moment, before, moment
from lakeops.sources import paths
from lakeops.sources.readers import date_partitions, file_date
from lakeops.sources.writers import DATE_PARTITIONS, LAYER_CODEC, balanced


@dataclass(frozen=True)
class RetentionRule:
    days: int
    action: str  # "delete" or "archive"


# ZSTD level of archives: written once, seldom read.
ARCHIVE_LEVEL = 15

# Retention per layer.
RETENTION = {
    "raw": RetentionRule(90, "archive"),
    "processed": RetentionRule(30, "delete"),
    "curated": RetentionRule(365, "archive"),
    "billing": RetentionRule(90, "delete"),
}


def retention_split(df: DataFrame, ts: str, as_of: Moment, rule: RetentionRule) -> tuple[DataFrame, DataFrame]:
    """``(kept, expired)`` rows; rows without a timestamp are kept."""
    cutoff = moment(as_of) - dt.timedelta(days=rule.days)
    old = F.coalesce(before(df, ts, cutoff), F.lit(False))
    return df.filter(~old), df.filter(old)


def retention_label(df: DataFrame, ts: str, as_of: Moment, rule: RetentionRule) -> DataFrame:
    """All rows with ``retention_action``: keep, or the rule's action."""
    cutoff = moment(as_of) - dt.timedelta(days=rule.days)
    old = F.coalesce(before(df, ts, cutoff), F.lit(False))
    return df.withColumn("retention_action", F.when(old, rule.action).otherwise("keep"))


def apply_retention(
    spark: SparkSession, path: str, layer: str, as_of: Moment, archive_path: str | None = None
) -> list[str]:
    """Archive or delete the expired ``year/month/day`` partitions of a layer.

    Only expired partitions are read; kept ones are not rewritten. Archived rows lie
    below their date in a ``batch`` named after the files they came from: a run that was
    interrupted before it deleted writes the same batch again, and rows that arrive
    late for an archived date become a further batch. Returns the removed dates.
    """
    rule = RETENTION[layer]
    last = moment(as_of).date() - dt.timedelta(days=rule.days + 1)
    table = spark.read.parquet(path)
    expired = table.filter(date_partitions(None, last))
    dates = [
        f"{y}-{m}-{d}"
        for y in _values(spark, path, "year")
        for m in _values(spark, f"{path}/year={y}", "month")
        for d in _values(spark, f"{path}/year={y}/month={m}", "day")
        if dt.date(int(y), int(m), int(d)) <= last
    ]
    if not dates:
        return []
    if rule.action == "archive":
        if archive_path is None:
            raise ValueError(f"layer {layer} is archived: name an archive path")
        padded = expired.withColumns(
            {"month": F.lpad(F.col("month").cast("string"), 2, "0"), "day": F.lpad(F.col("day").cast("string"), 2, "0")}
        )
        batches = {}
        for date in dates:
            y, m, d = date.split("-")
            names = paths.child_files(spark, f"{path}/year={y}/month={m}/day={d}")
            batches[f"{y}-{m}-{d}"] = hashlib.sha256("/".join(names).encode()).hexdigest()[:16]
        dated = F.concat_ws("-", F.col("year").cast("string"), "month", "day")
        batch = F.create_map(*[F.lit(x) for pair in batches.items() for x in pair])[dated]
        (
            balanced(padded.withColumn("batch", batch), *DATE_PARTITIONS, "batch")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", LAYER_CODEC["archive"])
            .option("parquet.compression.codec.zstd.level", ARCHIVE_LEVEL)
            .partitionBy(*DATE_PARTITIONS, "batch")
            .parquet(archive_path)
        )
    for date in dates:
        y, m, d = date.split("-")
        paths.delete_dir(spark, f"{path}/year={y}/month={m}/day={d}")
    return dates


def expire_files(
    spark: SparkSession, path: str, layer: str, as_of: Moment, ts: str | None = None,
    archive_path: str | None = None,
) -> list[str]:
    """Archive or delete whole files of a layer that has no date directories.

    A file is expired when all of it is: with ``ts``, when its newest row is older than
    the layer's term (Parquet; only that column is read, and a row without a time keeps
    its file); without, when the date that its name begins with is (``<date>.json``; only
    the listing is read). Files are never rewritten. An archive gets the rows of expired
    files as a ``batch`` named after those files, so an interrupted run writes the same
    batch again before it deletes them. Returns the removed files.
    """
    rule = RETENTION[layer]
    cutoff = moment(as_of) - dt.timedelta(days=rule.days)
    if ts is None:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)  # contents are not read
        dated = listed.select(F.col("path").alias("file"), file_date(F.element_at(F.split("path", "/"), -1)).alias("newest"))
        expired = dated.filter(F.col("newest") < F.lit(cutoff.date()))
    else:
        table = spark.read.parquet(path)
        old = F.coalesce(before(table, ts, cutoff), F.lit(False))
        files = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.bool_and(old).alias("old"))
        expired = files.filter("old")
    names = sorted(r["file"] for r in expired.select("file").toLocalIterator())
    if not names:
        return []
    if rule.action == "archive":
        if archive_path is None:
            raise ValueError(f"layer {layer} is archived: name an archive path")
        batch = hashlib.sha256("\n".join(n.rpartition("/")[2] for n in names).encode()).hexdigest()[:16]
        rows = spark.read.option("basePath", path).parquet(*names)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", LAYER_CODEC["archive"])
        writer.option("parquet.compression.codec.zstd.level", ARCHIVE_LEVEL).parquet(f"{archive_path}/batch={batch}")
    for name in names:
        paths.delete_dir(spark, name)
    return names


def _values(spark: SparkSession, path: str, key: str) -> list[str]:
    """Numeric values of one partition level (the NULL partition is never expired)."""
    values = [n.removeprefix(f"{key}=") for n in paths.child_dirs(spark, path)]
    return [v for v in values if v.isdigit()]
