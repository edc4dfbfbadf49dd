"""Session helpers: recommended settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings that the operators rely on; all may be set on a running session.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # state of streams on local disk instead of the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a write replaces only the partitions it contains
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SQL_DEFAULTS``. Cluster sizing (executors, shuffle partitions) is
    left to the deployment; AQE coalesces from ``shuffle.partitions`` down."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="lakeops-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may run without that setting; it then gets a
    temporary folder. On a cluster a machine-local path would be lost with its
    executor, so the missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
