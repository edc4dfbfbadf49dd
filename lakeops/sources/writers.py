"""Layer writers: raw landing, curated tables, idempotent partition writes."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from lakeops.functions.timeparts import Moment, instant

# Parquet codec per layer.
LAYER_CODEC = {"raw": "snappy", "processed": "zstd", "curated": "zstd", "archive": "zstd"}

DATE_PARTITIONS = ("year", "month", "day")

# Curated schemas; NOT NULL marks required fields.
_LOAD_FIELDS = "_dlt_load_id string, _dlt_id string, ingestion_timestamp timestamp"
CURATED_SCHEMAS = {
    "posts": "userId int NOT NULL, id int NOT NULL, title string NOT NULL, body string NOT NULL, "
    + _LOAD_FIELDS,
    "users": "id int NOT NULL, name string, username string, email string, phone string, "
    "website string, " + _LOAD_FIELDS,
}
FALLBACK_SCHEMA = "id string, data string, _dlt_load_id string, ingestion_timestamp timestamp"


def curated_schema(table: str) -> StructType:
    return StructType.fromDDL(CURATED_SCHEMAS.get(table, FALLBACK_SCHEMA))


def add_ingest_metadata(df: DataFrame, load_id: str, ingested_at: Moment) -> DataFrame:
    """Add ``ingestion_timestamp``, ``_dlt_load_id`` and a content-derived ``_dlt_id``.

    The id is a hash of load and row, so a retried task writes the same id, however the
    rows are partitioned. Equal rows of one load share it.
    """
    content = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return df.withColumns(
        {
            "ingestion_timestamp": instant(ingested_at).cast("timestamp"),
            "_dlt_load_id": F.lit(load_id),
            "_dlt_id": F.sha2(F.concat_ws("|", F.lit(load_id), content), 256),
        }
    )


def with_date_partitions(df: DataFrame, ts: str, hourly: bool = False) -> DataFrame:
    """Add zero-padded ``year/month/day`` (and ``hour``) partition columns."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd"} | ({"hour": "HH"} if hourly else {})
    return df.withColumns({name: F.date_format(ts, fmt) for name, fmt in parts.items()})


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Gather rows by partition value before a write, sized by AQE.

    Keeps the number of files per directory low; AQE splits a hot partition value
    over several tasks and merges small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_raw(
    df: DataFrame, base: str, table: str, mode: str = "append", ts: str = "ingestion_timestamp",
    layer: str = "raw", hourly: bool = False,
) -> str:
    """Write below ``base/table/year=/month=/day=``.

    ``append`` adds files; ``replace`` replaces the whole table, ``replace_dates`` only
    the dates that the frame contains.
    """
    path = f"{base.rstrip('/')}/{table}"
    parts = [*DATE_PARTITIONS, *(["hour"] if hourly else [])]
    rows = balanced(with_date_partitions(df, ts, hourly), *parts)
    writer = rows.write.partitionBy(*parts).option("compression", LAYER_CODEC[layer])
    if mode == "append":
        writer.mode("append").parquet(path)
    elif mode in ("replace", "replace_dates"):
        kind = "static" if mode == "replace" else "dynamic"
        writer.mode("overwrite").option("partitionOverwriteMode", kind).parquet(path)
    else:
        raise ValueError(f"mode must be append, replace or replace_dates, not {mode!r}")
    return path


def idempotent_write(df: DataFrame, path: str, partition_key: str | Sequence[str], layer: str = "processed") -> None:
    """Write so that a repeated run for the same partition values replaces them."""
    keys = [partition_key] if isinstance(partition_key, str) else list(partition_key)
    (
        balanced(df, *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", LAYER_CODEC[layer])
        .partitionBy(*keys)
        .parquet(path)
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to a declared schema by name; required fields must not be NULL.

    Absent optional columns become NULL. A NULL in a required column fails the
    job on the executor that meets it, without a separate counting pass.
    """
    missing = [f.name for f in schema.fields if not f.nullable and f.name not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")

    def field(f):
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        value = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            broken = F.raise_error(F.lit(f"NULL in required column {f.name}")).cast(f.dataType)
            value = F.coalesce(value, broken)
        return value.alias(f.name)

    return df.select(*map(field, schema.fields))


def null_violations(df: DataFrame, schema: StructType) -> DataFrame:
    """Count NULLs per required column in one pass: ``column, violations``."""
    required = [f.name for f in schema.fields if not f.nullable]
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in required]
    return counted.select(F.inline(F.array(*pairs)))


def write_json_files(df: DataFrame, base: str, name: Column, lone_objects: bool = False, rows_per_file: int = 100_000) -> DataFrame:
    """One JSON document ``base/<name>.json`` per value of ``name`` (null: its rows are not
    written): a list with an item per row, over several lines. With ``lone_objects`` a
    single row is an object without a list.

    Such a document can't be split, so a name with more than ``rows_per_file`` rows is
    dealt by row hash to further files ``<name>.<n>.json``. A file is streamed by one
    task and moved into place when whole; a retry replaces it by the same one. Returns
    ``file`` and ``rows``, a row per file: the files are there once that is read.
    """
    rows = df.select(name.cast("string").alias("_name"), F.to_json(F.struct(*df.columns)).alias("_json")).filter("_name IS NOT NULL")
    files_of = rows.groupBy("_name").agg(F.ceil(F.count("*") / rows_per_file).alias("_files"))
    dealt = rows.join(files_of, "_name").withColumn("_n", F.pmod(F.xxhash64("_json"), F.col("_files")))
    file = F.concat(F.col("_name"), F.when(F.col("_n") > 0, F.concat(F.lit("."), F.col("_n").cast("string"))).otherwise(F.lit("")), F.lit(".json"))
    gathered = dealt.select(file.alias("_file"), "_json").repartition("_file").sortWithinPartitions("_file")
    target = base.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(target)
        store.create_dir(folder, recursive=True)
        pairs = (pair for b in batches for pair in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for file, group in itertools.groupby(pairs, key=lambda pair: pair[0]):
            draft, held, n = f"{folder}/.{uuid.uuid4().hex}", None, 0
            with store.open_output_stream(draft) as out:
                for _, row in group:
                    if held is not None:
                        out.write(("[\n" if n == 1 else ",\n").encode() + held)
                    held, n = row.encode(), n + 1
                if n == 1 and lone_objects:
                    out.write(held + b"\n")
                else:
                    out.write(("[\n" if n == 1 else ",\n").encode() + held + b"\n]\n")
            store.move(draft, f"{folder}/{file}")
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([n], pa.int64())], ["file", "rows"])

    return gathered.mapInArrow(write, "file string, rows bigint")
