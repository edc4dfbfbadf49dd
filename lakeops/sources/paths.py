"""File-system access through Hadoop, so that any Spark-readable path works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly below ``path``, sorted."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``, sorted."""
    fs, jpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isFile())


def delete_dir(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def set_times(spark: SparkSession, directories: list[str], first_ms: int = 1_700_000_000_000) -> None:
    """Date the files of each directory one second after those of the directory before,
    as if they had landed in this order."""
    for i, path in enumerate(directories):
        fs, jpath = _fs(spark, path)
        for status in fs.listStatus(jpath):
            fs.setTimes(status.getPath(), first_ms + 1000 * i, -1)
