"""Daily anomaly tests: each day against the days before it.

Baseline of a day: mean and sample deviation of all earlier days of the window,
the day itself excluded. A day is anomalous if it lies more than ``z_threshold``
deviations away. With fewer than two earlier days, or a deviation of 0, it is not.

The tables are reduced to one row per day (and dimension value) by a map-side
aggregate before any window runs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.functions.timeparts import Moment, before, day, moment, not_before

COLUMN_METRICS = ("avg", "min", "max", "null_rate")


def _span(as_of: Moment, days_back: int) -> tuple[dt.date, dt.date]:
    """First day and the day after the last: ``days_back`` whole days before ``as_of``."""
    end = moment(as_of).date()
    return end - dt.timedelta(days=days_back), end


def _in_span(df: DataFrame, ts: str, as_of: Moment, days_back: int, where: Column | None) -> DataFrame:
    start, end = _span(as_of, days_back)
    kept = df.filter(not_before(df, ts, start) & before(df, ts, end))
    return kept if where is None else kept.filter(where)


def _days(as_of: Moment, days_back: int) -> Column:
    start, end = _span(as_of, days_back)
    literal = lambda d: F.lit(d.isoformat()).cast("date")
    return F.explode(F.sequence(literal(start), literal(end - dt.timedelta(days=1))))


def _flag(daily: DataFrame, keys: Sequence[str], value: str, z_threshold: float) -> DataFrame:
    earlier = Window.partitionBy(*keys).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    z = F.try_divide(F.col(value) - F.col("baseline_mean"), F.col("baseline_std"))
    # nine decimals: a day exactly on the threshold must not hang on the last bit
    beyond = F.abs(F.round("z_score", 9)) > z_threshold
    return (
        daily.withColumn("baseline_mean", F.avg(value).over(earlier))
        .withColumn("baseline_std", F.stddev_samp(value).over(earlier))
        .withColumn("z_score", z)
        .withColumn("is_anomaly", F.coalesce(beyond, F.lit(False)))
    )


def volume_anomalies(
    df: DataFrame, ts: str, as_of: Moment, z_threshold: float = 3.0, days_back: int = 30,
    where: Column | None = None,
) -> DataFrame:
    """Row counts per day; days without rows count as 0."""
    return dimension_anomalies(df, ts, (), as_of, z_threshold, days_back, where).drop("is_new")


def dimension_anomalies(
    df: DataFrame, ts: str, dimensions: Sequence[str], as_of: Moment, z_threshold: float = 3.0,
    days_back: int = 30, where: Column | None = None,
) -> DataFrame:
    """Row counts per day and dimension value; NULL is a value of its own.

    ``is_new`` marks the first day of a value that was never seen before it.
    """
    kept = _in_span(df, ts, as_of, days_back, where)
    counts = kept.groupBy(*dimensions, day(F.col(ts)).alias("date")).agg(F.count("*").alias("_n"))
    if dimensions:
        values = counts.select(*dimensions).distinct()
    else:
        values = df.sparkSession.range(1).select()
    empty_days = values.select(*dimensions, _days(as_of, days_back).alias("date"), F.lit(0).alias("_n"))
    filled = (
        counts.unionByName(empty_days)
        .groupBy(*dimensions, "date")
        .agg(F.sum("_n").alias("row_count"))
    )
    earlier = Window.partitionBy(*dimensions).orderBy("date").rowsBetween(
        Window.unboundedPreceding, -1
    )
    seen = F.coalesce(F.sum("row_count").over(earlier), F.lit(0))
    return _flag(filled, dimensions, "row_count", z_threshold).withColumn(
        "is_new", (seen == 0) & (F.col("row_count") > 0)
    )


def column_anomalies(
    df: DataFrame, ts: str, expression: Column, as_of: Moment,
    metrics: Sequence[str] = COLUMN_METRICS, z_threshold: float = 3.0, days_back: int = 30,
    where: Column | None = None,
) -> DataFrame:
    """Daily metrics of an expression: ``date, metric, value`` and the test.

    All metrics come from one aggregate. A day without a value (no rows, or only
    NULLs) is neither tested nor part of a baseline.
    """
    nulls = F.count_if(F.col("_x").isNull()).cast("double")
    measures = {
        "avg": F.avg("_x"), "min": F.min("_x"), "max": F.max("_x"), "null_rate": nulls / F.count("*"),
    }
    unknown = set(metrics) - set(measures)
    if unknown:
        raise ValueError(f"unknown metrics {sorted(unknown)}")
    daily = (
        _in_span(df, ts, as_of, days_back, where)
        .select(day(F.col(ts)).alias("date"), expression.cast("double").alias("_x"))
        .groupBy("date")
        .agg(*[measures[m].alias(m) for m in metrics])
    )
    long = daily.unpivot("date", list(metrics), "metric", "value").filter("value IS NOT NULL")
    return _flag(long, ["metric"], "value", z_threshold)


def all_columns_anomalies(
    df: DataFrame, ts: str, columns: Sequence[str], as_of: Moment, **options
) -> DataFrame:
    """``column_anomalies`` for several columns, with the column's name."""
    return reduce(
        DataFrame.unionByName,
        [
            column_anomalies(df, ts, F.col(c), as_of, **options).withColumn("column", F.lit(c))
            for c in columns
        ],
    )
