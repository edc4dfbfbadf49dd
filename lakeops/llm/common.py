"""What the operators of this package share: shared-folder tables and column names."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@functools.cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="llm-")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names. Only a local
    session may lack that setting; it then gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _finished_shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs inside drop their shuffle files when they end: their result is in a table."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there, and the
    table outlives any executor."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    with _finished_shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[str], name: str, label: str) -> DataFrame:
    """``df`` as a written table with a column ``name``: each row's place, from 0, in the
    order of the columns ``order``. Rows are range-partitioned, so the order of no key is
    made by one task; rows that are equal in ``order`` may part too, and have their places
    in any order. Only the row count of each partition comes to the driver."""
    spark, tie, part = df.sparkSession, fresh(df.columns, "tie"), fresh([*df.columns, name], "part")
    spread = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*order, tie)
    placed = spread.sortWithinPartitions(*order, tie).drop(tie).withColumn(name, F.monotonically_increasing_id())
    placed = written(placed, label)  # partition number times 2**33, plus the place within it
    of = F.shiftright(name, 33)
    before, rows = 0, []
    for p, n in sorted(tuple(r) for r in placed.groupBy(of).count().collect()):
        rows.append((p, before - (p << 33)))
        before += n
    shift = fresh([*df.columns, name, part], "shift")
    bases = spark.createDataFrame(rows, f"`{part}` bigint, `{shift}` bigint")  # one row per partition
    out = placed.withColumn(part, of).join(F.broadcast(bases), part)
    return out.withColumn(name, F.col(name) + F.col(shift)).select(*df.columns, name)


def fresh(names: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no name equals it."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_system(path: str):
    """(pyarrow file system, path inside it) for writes and ranged reads inside tasks:
    ``file:``, ``hdfs:``, ``s3:``, ``gs:`` and ``abfs:`` addresses or absolute paths."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_once(path: str, parts: Iterable[bytes]) -> int:
    """Write a file under another name, then move it into place; bytes written. Two
    attempts of a task can't mix their output."""
    files, target = file_system(path)
    files.create_dir(target.rpartition("/")[0], recursive=True)
    draft, size = f"{target}.{uuid.uuid4().hex}", 0
    with files.open_output_stream(draft) as out:
        for part in parts:
            size += out.write(part) or len(part)
    files.move(draft, target)
    return size
