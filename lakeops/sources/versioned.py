"""Curated tables with snapshots, on plain Parquet directories.

Every commit is one directory ``commit=<timestamp>-<kind>-<partition columns>`` that
Spark marks with ``_SUCCESS`` when its job commits; ``full`` starts a new state,
``append`` adds to it. A reader takes the newest ``full`` at or before its moment and the appends
after it. Nothing is overwritten in place, so a running reader keeps its files
and a failed write is never seen. Only one writer at a time is supported.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakeops.functions.timeparts import Moment, moment
from lakeops.sources import paths
from lakeops.sources.readers import input_bytes
from lakeops.sources.writers import LAYER_CODEC, balanced, conform

_STAMP = "%Y%m%dT%H%M%S%f"
TARGET_FILE_BYTES = 512 * 1024 * 1024


class Commit(NamedTuple):
    at: dt.datetime
    kind: str  # "full" or "append"
    layout: tuple[str, ...]  # partition columns of its directory

    def directory(self, path: str) -> str:
        return f"{path}/commit={self.at.strftime(_STAMP)}-{self.kind}-{','.join(self.layout)}"


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """Committed versions in time order."""
    out = []
    for name in paths.child_dirs(spark, path):
        if name.startswith("commit=") and paths.exists(spark, f"{path}/{name}/_SUCCESS"):
            stamp, kind, layout = name.removeprefix("commit=").split("-", 2)
            out.append(Commit(dt.datetime.strptime(stamp, _STAMP), kind, tuple(layout.split(","))))
    return out


def _live(versions: list[Commit], as_of: dt.datetime | None) -> list[Commit]:
    """The newest full version at or before ``as_of`` and the appends after it."""
    seen = [v for v in versions if as_of is None or v.at <= as_of]
    fulls = [i for i, v in enumerate(seen) if v.kind == "full"]
    return seen[fulls[-1] if fulls else 0 :]


def _write(rows: DataFrame, path: str, commit: Commit) -> None:
    (
        balanced(rows, *commit.layout)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", LAYER_CODEC["curated"])
        .partitionBy(*commit.layout)
        .parquet(commit.directory(path))
    )


def _read(spark: SparkSession, path: str, versions: list[Commit], schema: StructType | None) -> DataFrame:
    """All rows of some versions: one scan per partition layout, columns by name."""
    layouts = dict.fromkeys(v.layout for v in versions)
    scans = []
    for layout in layouts:
        reader = spark.read.option("basePath", path)
        if schema is None:
            reader = reader.option("mergeSchema", "true")
        else:
            reader = reader.schema(StructType(list(schema.fields)).add("_day", "date"))
        scans.append(reader.parquet(*[v.directory(path) for v in versions if v.layout == layout]))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), scans).drop("commit")


def write_curated(
    df: DataFrame, path: str, schema: StructType, committed_at: Moment, mode: str = "append",
    partition_ts: str = "ingestion_timestamp", partition_by: tuple[str, ...] | None = None,
) -> None:
    """Commit rows in a declared schema, partitioned by the day of ``partition_ts``.

    ``mode``: ``append`` or ``overwrite``. Repeating a commit of the same moment
    replaces that commit, so a restarted job does not load twice. The partition
    layout is that of the newest version unless ``partition_by`` names another
    (``_day`` is the day of ``partition_ts``).
    """
    kind = {"append": "append", "overwrite": "full"}[mode]
    spark, at = df.sparkSession, moment(committed_at)
    known = commits(spark, path)
    if known and known[-1].at > at:
        raise ValueError("a later commit exists; commits must move forward in time")
    layout = partition_by or (known[-1].layout if known else ("_day",))
    _write(conform(df, schema).withColumn("_day", F.to_date(partition_ts)), path, Commit(at, kind, layout))


def read_curated(
    spark: SparkSession, path: str, as_of: Moment | None = None, schema: StructType | None = None,
    days: tuple[Moment, Moment] | None = None,
) -> DataFrame:
    """The table now, or as it was at ``as_of``; ``days`` prunes to a day range.

    Columns added by later commits are NULL in older rows. Name ``schema`` for
    large tables: finding it out opens every file footer.
    """
    live = _live(commits(spark, path), None if as_of is None else moment(as_of))
    if not live:
        raise ValueError(f"no version of {path} at {as_of or 'present'}")
    df = _read(spark, path, live, schema)
    if days is not None:
        low, high = (F.lit(moment(d).date().isoformat()).cast("date") for d in days)
        df = df.filter(F.col("_day").between(low, high))
    return df.drop("_day")


def list_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """``snapshot_ts, kind, is_current``; metadata only."""
    versions = commits(spark, path)
    live = set(_live(versions, None))
    rows = [(v.at, v.kind, v in live) for v in versions]
    return spark.createDataFrame(rows, "snapshot_ts timestamp_ntz, kind string, is_current boolean")


def expire_snapshots(
    spark: SparkSession, path: str, as_of: Moment, older_than_days: int = 30
) -> list[dt.datetime]:
    """Delete versions older than the limit that the current state does not need."""
    cutoff = moment(as_of) - dt.timedelta(days=older_than_days)
    versions = commits(spark, path)
    live = set(_live(versions, None))
    # a version that a younger, kept snapshot is built on must stay as well
    for v in versions:
        if v.at >= cutoff:
            live |= set(_live(versions, v.at))
    dropped = [v for v in versions if v not in live]
    for v in dropped:
        paths.delete_dir(spark, v.directory(path))
    return [v.at for v in dropped]


def compact(
    spark: SparkSession, path: str, committed_at: Moment, target_bytes: int = TARGET_FILE_BYTES,
    partition_by: tuple[str, ...] = ("_day",),
) -> int:
    """Rewrite the current state as one full version with files near ``target_bytes``.

    AQE sizes the write tasks: small partition values are merged, a hot one is
    split. ``partition_by`` may add columns (partition evolution). Returns the
    bytes read.
    """
    rows = _read(spark, path, _live(commits(spark, path), None), None)
    size = input_bytes(rows)
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, str(target_bytes))
    try:
        _write(rows, path, Commit(moment(committed_at), "full", partition_by))
    finally:
        spark.conf.set(advisory, before)
    return size
