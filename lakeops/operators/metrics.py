"""Counting, summing and reporting over facts and events.

All of these are hash aggregates with map-side partial results: a hot group
shuffles one row per input partition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions.timeparts import (
    Moment,
    after,
    before,
    day,
    moment,
    not_before,
    seconds_between,
    since,
)


def daily_metrics(df: DataFrame, ts: str = "created_at", amount: str = "amount") -> DataFrame:
    """Per day: ``total_records, total_amount``."""
    return df.groupBy(F.date_trunc("day", F.col(ts).cast("timestamp")).cast("date").alias("date")).agg(
        F.count("*").alias("total_records"), F.sum(amount).alias("total_amount")
    )


def daily_events(df: DataFrame, ts: str = "event_timestamp", kind: str = "event_type") -> DataFrame:
    """Per (date, type): ``event_count``."""
    return df.groupBy(day(F.col(ts)).alias("event_date"), F.col(kind).alias("event_type")).agg(
        F.count("*").alias("event_count")
    )


def events_by_type(
    df: DataFrame,
    as_of: Moment,
    days: int = 7,
    ts: str = "event_timestamp",
    kind: str = "event_type",
    value: str = "value",
) -> DataFrame:
    """Last ``days``: count and mean value per type, most frequent first."""
    return (
        df.filter(since(df, ts, as_of, days=days))
        .groupBy(F.col(kind).alias("event_type"))
        .agg(F.count("*").alias("event_count"), F.avg(value).alias("avg_value"))
        .orderBy(F.desc("event_count"), "event_type")
    )


def hourly_categories(
    df: DataFrame,
    as_of: Moment,
    hours: int = 24,
    ts: str = "timestamp",
    category: str = "event_category",
    user: str = "user_id",
) -> DataFrame:
    """Per hour and category: events and distinct users, newest hour first."""
    return (
        df.filter(since(df, ts, as_of, hours=hours))
        .groupBy(
            F.date_trunc("hour", F.col(ts).cast("timestamp")).cast("timestamp_ntz").alias("hour"),
            F.col(category).alias("event_category"),
        )
        .agg(F.count("*").alias("event_count"), F.countDistinct(user).alias("unique_users"))
        .orderBy(F.desc("hour"), F.desc("event_count"), "event_category")
    )


def run_stats(
    runs: DataFrame,
    as_of: Moment,
    days: int = 30,
    name: str = "flow_name",
    start: str = "start_time",
    end: str = "end_time",
    status: str = "status",
) -> DataFrame:
    """Per flow and day: total, successful and failed runs, mean duration in seconds.

    Runs without an end do not count towards the mean.
    """
    return (
        runs.filter(since(runs, start, as_of, days=days))
        .groupBy(F.col(name).alias("flow_name"), day(F.col(start)).alias("date"))
        .agg(
            F.count("*").alias("total_runs"),
            F.count_if(F.col(status) == "COMPLETED").alias("successful"),
            F.count_if(F.col(status) == "FAILED").alias("failed"),
            F.avg(seconds_between(F.col(start), F.col(end))).alias("avg_duration_seconds"),
        )
        .orderBy(F.desc("date"), "flow_name")
    )


def latency_by_model(
    points: DataFrame, as_of: Moment, hours: int = 24, ts: str = "timestamp",
    model: str = "model", latency: str = "latency_ms",
) -> DataFrame:
    """Per model: mean and highest latency, number of requests."""
    return (
        points.filter(after(points, ts, moment(as_of) - dt.timedelta(hours=hours)))
        .groupBy(F.col(model).alias("model"))
        .agg(
            F.avg(latency).alias("avg_latency_ms"),
            F.max(latency).alias("max_latency_ms"),
            F.count("*").alias("total_requests"),
        )
    )


def stage_latency(
    points: DataFrame, as_of: Moment, stages: dict[str, str], hours: int = 24, ts: str = "timestamp"
) -> DataFrame:
    """Mean of each stage timing; ``stages`` maps output name to column."""
    recent = points.filter(after(points, ts, moment(as_of) - dt.timedelta(hours=hours)))
    return recent.agg(*[F.avg(c).alias(out) for out, c in stages.items()])


def usage_by_worker(
    points: DataFrame, worker: str, cpu_ms: str, latency_ms: str | None = None, ts: str = "timestamp"
) -> DataFrame:
    """Per date and worker: requests, CPU milliseconds and optionally mean latency."""
    extra = [F.avg(latency_ms).alias("avg_latency_ms")] if latency_ms else []
    return points.groupBy(day(F.col(ts)).alias("date"), F.col(worker).alias("worker_name")).agg(
        F.count("*").alias("requests"), F.sum(cpu_ms).alias("total_cpu_time_ms"), *extra
    )


def category_totals(df: DataFrame, category: str = "category", amount: str = "amount") -> DataFrame:
    """Per category sum beside the whole batch's count, sum and mean.

    The batch row is summed from the category rows, not from the input again. It
    has ``is_total`` true; its mean is NULL for an empty batch.
    """
    per_category = df.groupBy(category).agg(
        F.count("*").alias("records"), F.sum(amount).alias("total"), F.count(amount).alias("_n")
    )
    total = per_category.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.sum("total").alias("total"),
        F.sum("_n").alias("_n"),
    ).select(F.lit(None).cast(df.schema[category].dataType).alias(category), "records", "total", "_n",
             F.lit(True).alias("is_total"))
    both = per_category.withColumn("is_total", F.lit(False)).unionByName(total)
    return both.withColumn("average", F.try_divide("total", "_n")).drop("_n")


def top_counts(df: DataFrame, key: str, limit: int | None = 10, out: str = "post_count") -> DataFrame:
    """Rows per key, most first, ties by key; ``limit=None`` lists every key."""
    counted = df.groupBy(key).agg(F.count("*").alias(out)).orderBy(F.desc(out), key)
    return counted if limit is None else counted.limit(limit)


def daily_report(
    df: DataFrame, as_of: Moment, ts: str, user: str, duration: Column
) -> DataFrame:
    """The day before ``as_of``: events, distinct users, mean session duration.

    Always one row; the mean is NULL on an empty day.
    """
    end = moment(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    start = end - dt.timedelta(days=1)
    previous = df.filter(not_before(df, ts, start) & before(df, ts, end))
    return previous.agg(
        F.lit(start.date().isoformat()).cast("date").alias("report_date"),
        F.count("*").alias("total_events"),
        F.countDistinct(user).alias("unique_users"),
        F.avg(duration).alias("avg_session_duration"),
    )


def recent_totals(
    daily: DataFrame, as_of: Moment, days: int = 7, date: str = "event_date", count: str = "event_count"
) -> DataFrame:
    """Re-aggregate a daily table: summed count per date over the last ``days``."""
    return (
        daily.filter(since(daily, date, as_of, days=days))
        .groupBy(F.col(date).alias("event_date"))
        .agg(F.sum(count).alias("total_events"))
        .orderBy(F.desc("event_date"))
    )


def daily_bitmaps(df: DataFrame, keys: Sequence[str] = (), ts: str = "timestamp", user: str = "user_id") -> DataFrame:
    """Exact sets of integer ids per day that merge over days: ``date``, ``keys``, ``bucket`` and
    ``bitmap``, 32,768 ids to a bucket.

    Meant for dense ids: a bitmap has 4 KB however few of its ids occur. Bitmaps are built
    map-side and or-ed, so a hot day costs one row per bucket and task.
    """
    id_ = F.col(user).cast("bigint")
    rows = df.filter(id_.isNotNull()).select(
        F.to_date(ts).alias("date"), *keys, F.bitmap_bucket_number(id_).alias("bucket"), F.bitmap_bit_position(id_).alias("_bit"))
    return rows.groupBy("date", *keys, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def distinct_users(bitmaps: DataFrame, *by: Column | str) -> DataFrame:
    """``unique_users`` per group of ``by``: days of ``daily_bitmaps`` added up without the events."""
    groups = [F.col(c) if isinstance(c, str) else c for c in by]
    names = [f"_g{i}" for i in range(len(groups))]
    merged = bitmaps.groupBy(*(g.alias(n) for g, n in zip(groups, names)), "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    counts = merged.groupBy(*names).agg(F.sum(F.bitmap_count("bitmap")).alias("unique_users"))
    shown = bitmaps.select(*groups).columns
    return counts.withColumnsRenamed(dict(zip(names, shown)))
