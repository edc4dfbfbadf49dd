"""Upserts, incremental selection, history and reverse-ETL selection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, TimestampType

from lakeops.functions.timeparts import Moment, instant, moment
from lakeops.operators.ordered import latest_per_key, neighbor


def split_by_keys(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(touched, untouched)`` rows of ``df`` by whether their key occurs in ``keys_of``.

    A small key set is broadcast by AQE, so that a large table is not shuffled at
    all; with a large one both halves share one shuffle of ``df``. NULL is a key.
    """
    wanted = keys_of.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(wanted, same, "left_semi"), df.join(wanted, same, "left_anti")


def merge_by_key(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order_col: str
) -> DataFrame:
    """Upsert: per updated key keep the row with the highest ``order_col``.

    On equal ``order_col`` an update beats a target row; among equal updates the
    row with the larger content hash wins, so that a retried task agrees. Target
    rows without an update pass through as they are.
    """
    contested, untouched = split_by_keys(target, updates, keys)
    both = contested.withColumn("_side", F.lit(0)).unionByName(
        updates.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    latest = _latest_deterministic(both, keys, [order_col, "_side"]).drop("_side")
    return untouched.unionByName(latest, allowMissingColumns=True)


def _latest_deterministic(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``latest_per_key`` with the content hash as last resort."""
    tie = F.xxhash64(*[F.col(c).cast("string") for c in df.columns])
    return latest_per_key(df.withColumn("_tie", tie), keys, [*order_by, "_tie"]).drop("_tie")


def high_water_mark(target: DataFrame, ts: str) -> Column | None:
    """Largest ``ts`` in the target as a literal, or None.

    One scalar, answered from Parquet statistics where the source supports aggregate
    pushdown. An instant travels as microseconds: a Python datetime would be read in
    the time zone of the driver's process.
    """
    top = F.max(ts)
    if isinstance(target.schema[ts].dataType, TimestampType):
        mark = target.agg(F.unix_micros(top)).first()[0]
        return None if mark is None else F.timestamp_micros(F.lit(mark))
    mark = target.agg(top.cast("string")).first()[0]
    return None if mark is None else F.lit(mark)


def incremental_filter(source: DataFrame, target: DataFrame | None, ts: str) -> DataFrame:
    """Source rows newer than the target; all rows if the target is missing or empty.

    The mark is fetched first and compared as a literal, so that the filter
    reaches the Parquet scan of the source.
    """
    mark = None if target is None else high_water_mark(target, ts)
    if mark is None:
        return source
    return source.filter(F.col(ts) > mark.cast(source.schema[ts].dataType))


def evolve_schema(
    df: DataFrame,
    add: Mapping[str, DataType | str] | None = None,
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rename columns, then append new ones as NULL of the given type."""
    out = df.withColumnsRenamed(dict(rename or {}))
    clash = [c for c in (add or {}) if c in out.columns]
    if clash:
        raise ValueError(f"columns exist already: {clash}")
    return out.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (add or {}).items()])


def union_evolved(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Append across a schema change: columns by name, missing ones NULL."""
    return older.unionByName(newer, allowMissingColumns=True)


def append_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Multi-source append by column name (duplicates kept)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scd2_snapshot(
    current: DataFrame, incoming: DataFrame, key: str, updated_at: str
) -> DataFrame:
    """Timestamp-strategy history: every version of a key with its validity.

    Adds ``valid_from``, ``valid_to``, ``is_current``. Versions with equal
    (key, updated_at) count once, the incoming one winning. If ``current`` is an
    earlier result of this function, only the keys that come in are recomputed.
    """
    validity = ("valid_from", "valid_to", "is_current")
    if all(c in current.columns for c in validity):
        current, done = split_by_keys(current, incoming, [key])
    else:
        done = None
    versions = _latest_deterministic(
        current.drop(*validity).withColumn("_side", F.lit(0)).unionByName(incoming.withColumn("_side", F.lit(1))),
        [key, updated_at],
        ["_side"],
    ).drop("_side")
    chunk = F.date_trunc("month", F.col(updated_at).cast("timestamp"))
    history = neighbor(
        versions, [key], chunk, [updated_at], updated_at, out="valid_to", previous=False
    )
    history = history.withColumn("valid_from", F.col(updated_at)).withColumn(
        "is_current", F.col("valid_to").isNull()
    )
    return history if done is None else done.unionByName(history)


def outbox_candidates(
    df: DataFrame,
    flag: str,
    last_synced: str,
    as_of: Moment,
    order_by: Sequence[str],
    ledger: DataFrame | None = None,
    key: str | None = None,
    limit: int = 1000,
) -> DataFrame:
    """Rows to send out: flagged, last synced more than an hour ago, first ``limit``.

    ``limit`` is the feature (one batch per run). ``order_by`` must be total.
    Rows that a ledger marks as synced within the hour are left out.
    """
    cutoff = instant(moment(as_of) - dt.timedelta(hours=1))
    due = df.filter(F.col(flag) & (F.col(last_synced).cast("timestamp_ntz") < cutoff))
    if ledger is not None:
        done = ledger.filter(
            (F.col("status") == "synced") & (F.col("synced_at").cast("timestamp_ntz") >= cutoff)
        ).select(key)
        due = due.join(done.distinct(), key, "left_anti")
    return due.orderBy(*order_by).limit(limit)


def sync_ledger_rows(results: DataFrame, key: str, as_of: Moment) -> DataFrame:
    """Ledger rows ``(key, status, error, synced_at)`` from send results that carry
    a nullable ``error`` column."""
    return results.select(
        F.col(key),
        F.when(F.col("error").isNull(), "synced").otherwise("failed").alias("status"),
        F.col("error"),
        instant(as_of).alias("synced_at"),
    )
