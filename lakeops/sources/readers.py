"""Scans over raw, billing, upload and change-event files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakeops.functions.timeparts import Moment, moment

BILLING_SCHEMA = (
    "date date, service string, resource string, metric string, quantity double, "
    "unit_cost double, total_cost double, currency string"
)


def date_partitions(start: Moment | None, end: Moment | None) -> Column:
    """Predicate on ``year/month/day`` partition columns for [start, end].

    Only partition columns occur in it, so Spark lists and reads just the
    matching directories; a filter on a timestamp inside the files would not prune.
    """
    date = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    keep = F.lit(True)
    if start is not None:
        keep = keep & (date >= F.lit(moment(start).date().isoformat()).cast("date"))
    if end is not None:
        keep = keep & (date <= F.lit(moment(end).date().isoformat()).cast("date"))
    return keep


def read_layer(
    spark: SparkSession, base: str, table: str, start: Moment | None = None, end: Moment | None = None,
    schema: StructType | str | None = None, merge_schema: bool = False,
) -> DataFrame:
    """All Parquet files below ``base/table``, partition columns included.

    With ``start``/``end`` the table must have ``year/month/day`` partitions.
    ``merge_schema`` reads evolving raw tables; pass ``schema`` where it is known,
    as merging opens every file footer.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(f"{base.rstrip('/')}/{table}")
    return df if start is None and end is None else df.filter(date_partitions(start, end))


def read_raw_json(
    spark: SparkSession, paths: str | list[str], schema: StructType | str, multi_line: bool = True
) -> DataFrame:
    """One row per item of a top-level list, or one row for a single object.

    Documents that span lines cannot be split, so size landed files accordingly;
    set ``multi_line=False`` for newline-delimited files, which can.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(paths)


def file_date(name: Column | None = None) -> Column:
    """The date that a file's name begins with, null if none: ``<date>.json``."""
    name = F.col("_metadata.file_name") if name is None else name
    return F.try_to_date(F.substring(name, 1, 10), "yyyy-MM-dd")


def read_billing(
    spark: SparkSession, base: str, prefix: str = "", start: Moment | None = None, end: Moment | None = None,
    modified_after: Moment | None = None,
) -> DataFrame:
    """Daily billing files ``<date>.json`` of one folder, with ``file_date``.

    Files are pruned before any is opened: ``prefix`` (``2025-``) limits the names
    listed, ``modified_after`` the files by their time, and ``start``/``end`` (both
    included) become a predicate on the file name, which Spark applies to its listing.
    """
    reader = spark.read.schema(BILLING_SCHEMA).option("multiLine", True).option("pathGlobFilter", f"{prefix}*.json")
    if modified_after is not None:
        reader = reader.option("modifiedAfter", moment(modified_after).strftime("%Y-%m-%dT%H:%M:%S"))
    rows = reader.json(base.rstrip("/"))
    name = F.col("_metadata.file_name")
    if start is not None:
        rows = rows.filter(name >= moment(start).date().isoformat())
    if end is not None:  # names go on behind the date, and "~" follows all that do
        rows = rows.filter(name <= moment(end).date().isoformat() + "~")
    return rows.withColumn("file_date", file_date())


def read_upload(
    spark: SparkSession, path: str, fmt: str, schema: StructType | str, header: bool = True
) -> DataFrame:
    """CSV, JSON-lines or Parquet drop folder with a declared schema (no inference pass)."""
    if fmt == "csv":
        return spark.read.schema(schema).option("header", header).csv(path)
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    raise ValueError(f"unsupported upload format {fmt!r}")


def cdc_schema(row_schema: str) -> str:
    """Change-event schema around a table's row schema (DDL)."""
    return (
        f"operation string, `table` string, before struct<{_as_struct(row_schema)}>, "
        f"after struct<{_as_struct(row_schema)}>, timestamp timestamp"
    )


def _as_struct(ddl: str) -> str:
    fields = StructType.fromDDL(ddl).fields
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in fields)


def read_cdc(spark: SparkSession, path: str, row_schema: str, multi_line: bool = False) -> DataFrame:
    """Change events of all tables and dates below ``path`` (also nested folders)."""
    reader = spark.read.schema(cdc_schema(row_schema)).option("recursiveFileLookup", "true")
    return reader.option("multiLine", multi_line).json(path)


def sample_rows(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` random rows (a top-n by random key, not a full sort)."""
    return df.orderBy(F.rand(seed)).limit(n)


def head(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def file_inventory(
    df: DataFrame, layer: str | None = None, threshold_bytes: int | None = None
) -> DataFrame:
    """One row: files, bytes and whether the bytes exceed a threshold.

    Reads only file metadata columns; rows are folded per file before the shuffle.
    """
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.max("_metadata.file_size").alias("bytes")
    )
    totals = per_file.agg(
        F.count("*").alias("object_count"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes")
    )
    over = F.lit(False) if threshold_bytes is None else F.col("total_bytes") > threshold_bytes
    return totals.select(F.lit(layer).cast("string").alias("layer"), "*", over.alias("over_threshold"))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a frame, from the file listing (no scan)."""
    spark = df.sparkSession
    files = df.inputFiles()
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    return sum(path(f).getFileSystem(conf).getFileStatus(path(f)).getLen() for f in files)


def parquet_codecs(df: DataFrame) -> DataFrame:
    """``codec`` and ``rows`` of every row group behind a Parquet frame, from the footers alone,
    which tasks read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet

        for b in batches:
            for name in b.column(0).to_pylist():
                files, path = fs.FileSystem.from_uri(name)
                with files.open_input_file(path) as source:
                    footer = parquet.ParquetFile(source).metadata
                groups = [footer.row_group(i) for i in range(footer.num_row_groups)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g.column(0).compression for g in groups], pa.string()), pa.array([g.num_rows for g in groups], pa.int64())], ["codec", "rows"])

    listed = df.sparkSession.createDataFrame([(f,) for f in df.inputFiles()], "file string")  # the scan's own listing
    return listed.mapInArrow(read, "codec string, rows bigint")
