"""Fact and report models.

``fct_user_posts`` follows its published definition. The models from
``session_aggregated`` on are only named in the storage layout this library
covers; their definitions are this library's own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeops.functions.timeparts import Moment, instant, month, moment
from lakeops.operators.ordered import islands
from lakeops.operators.merge import merge_by_key


def fct_user_posts(
    users: DataFrame, posts: DataFrame, calculated_at: Moment,
    user_columns: Sequence[str] = ("user_id", "user_name", "username", "email"),
) -> DataFrame:
    """Post counts and body lengths per user; users without posts stay, with count 0.

    Posts are folded per user before the join, so a user with very many posts
    joins as one row. Repeated user rows multiply their counts, as in a join of
    the raw rows.
    """
    per_user = posts.groupBy("user_id").agg(
        F.count("post_id").alias("_posts"),
        F.sum(F.length("body").cast("bigint")).alias("_chars"),
        F.count("body").alias("_bodies"),
        F.max(F.length("body")).alias("max_post_length"),
        F.min(F.length("body")).alias("min_post_length"),
        F.max("loaded_at").alias("last_post_loaded_at"),
    )
    people = users.groupBy(*user_columns).agg(F.count("*").alias("_copies"))
    return people.join(per_user, "user_id", "left").select(
        *user_columns,
        (F.coalesce("_posts", F.lit(0)) * F.col("_copies")).alias("total_posts"),
        F.try_divide(F.col("_chars").cast("double"), F.col("_bodies")).alias("avg_post_length"),
        "max_post_length",
        "min_post_length",
        "last_post_loaded_at",
        instant(calculated_at).alias("calculated_at"),
    )


def grain_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def session_aggregated(
    events: DataFrame, user: str = "user_id", ts: str = "ts", value: str | None = "value",
    gap_minutes: int = 30,
) -> DataFrame:
    """One row per user session with a 30-minute gap rule and its duration in seconds."""
    aggregates = {"total_value": ("sum", F.col(value))} if value else {}
    sessions = islands(events, [user], ts, gap_minutes * 60, aggregates)
    span = F.unix_micros(F.col("session_end").cast("timestamp")) - F.unix_micros(
        F.col("session_start").cast("timestamp")
    )
    return sessions.withColumn("duration_seconds", span / F.lit(1_000_000.0))


def user_activity(
    events: DataFrame, user: str = "user_id", ts: str = "ts", kind: str = "event_type"
) -> DataFrame:
    """Per user: events, kinds, active days, first and last seen.

    Rows are folded per user, kind and day first. The two distinct counts are then sets
    of a user's few kinds and days, and no row is expanded.
    """
    folded = events.groupBy(user, F.col(kind).alias("_kind"), F.to_date(ts).alias("_day")).agg(
        F.count("*").alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last")
    )
    return folded.groupBy(user).agg(
        F.sum("_n").alias("event_count"),
        F.size(F.collect_set("_kind")).cast("bigint").alias("event_types"),
        F.size(F.collect_set("_day")).cast("bigint").alias("active_days"),
        F.min("_first").alias("first_seen"),
        F.max("_last").alias("last_seen"),
    )


def user_events(events: DataFrame, user: str = "user_id", kind: str = "event_type", value: str = "value") -> DataFrame:
    """Per user and kind: events and summed value."""
    return events.groupBy(user, kind).agg(
        F.count("*").alias("event_count"), F.sum(value).alias("total_value")
    )


def order_enriched(orders: DataFrame, customers: DataFrame, lines: DataFrame) -> DataFrame:
    """Order with customer attributes and line totals; lines are folded per order first."""
    totals = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("line_count"),
        F.sum("l_quantity").alias("total_quantity"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_amount"),
    )
    people = customers.select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey"
    )
    return (
        orders.join(people, "o_custkey", "left")
        .join(totals, "o_orderkey", "left")
        .withColumn("line_count", F.coalesce("line_count", F.lit(0)))
        .select(
            "o_orderkey", "o_custkey", "c_name", "c_mktsegment", "c_nationkey", "o_orderdate",
            "o_totalprice", "line_count", "total_quantity", "net_amount",
        )
    )


def product_metrics(parts: DataFrame, lines: DataFrame) -> DataFrame:
    """Per product: lines, quantity, net revenue, mean discount; unsold products stay."""
    sold = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count("*").alias("line_count"),
        F.sum("l_quantity").alias("quantity"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        F.avg("l_discount").alias("avg_discount"),
    )
    return (
        parts.select("p_partkey", "p_name", "p_brand", "p_type")
        .join(sold, "p_partkey", "left")
        .withColumn("line_count", F.coalesce("line_count", F.lit(0)))
    )


def revenue_summary(lines: DataFrame) -> DataFrame:
    """Per month and return flag: orders, gross and net revenue."""
    return lines.groupBy(month(F.col("l_shipdate")).alias("month"), "l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"),
        F.sum("l_extendedprice").alias("gross_revenue"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_revenue"),
    )


def dim_users(customers: DataFrame, nations: DataFrame, regions: DataFrame) -> DataFrame:
    """User dimension with nation and region names."""
    places = nations.join(regions, nations.n_regionkey == regions.r_regionkey, "left").select(
        "n_nationkey", "n_name", "r_name"
    )
    return customers.join(places, customers.c_nationkey == places.n_nationkey, "left").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
    )


def dim_products(parts: DataFrame) -> DataFrame:
    return parts.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("product_type"),
        F.col("p_size").alias("size"),
    ).distinct()


def dim_dates(df: DataFrame, ts: str) -> DataFrame:
    """Calendar over the span of ``ts``: one row per day, gaps included."""
    span = df.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
    days = span.filter("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.day("date").alias("day"),
        F.weekofyear("date").alias("iso_week"),
        (F.weekday("date") + 1).alias("iso_weekday"),
        (F.weekday("date") >= 5).alias("is_weekend"),
    )


def fct_daily_metrics(events: DataFrame, ts: str = "ts", user: str = "user_id", value: str = "value") -> DataFrame:
    """Per day: events, distinct users, summed value."""
    return events.groupBy(F.to_date(ts).alias("date")).agg(
        F.count("*").alias("event_count"),
        F.countDistinct(user).alias("unique_users"),
        F.sum(value).alias("total_value"),
    )


def refresh_daily_metrics(
    target: DataFrame, events: DataFrame, since_day: Moment, ts: str = "ts", user: str = "user_id",
    value: str = "value",
) -> DataFrame:
    """Incremental form: recompute the days from ``since_day`` on and merge them in.

    Whole days are recomputed, because distinct users do not add up.
    """
    first = moment(since_day).date().isoformat()
    start = F.lit(first).cast(events.schema[ts].dataType)
    fresh = fct_daily_metrics(events.filter(F.col(ts) >= start), ts, user, value)
    return merge_by_key(target, fresh, ["date"], "date")


def monthly_summary(lines: DataFrame) -> DataFrame:
    """Per month: lines, quantity, gross revenue."""
    return lines.groupBy(month(F.col("l_shipdate")).alias("month")).agg(
        F.count("*").alias("line_count"),
        F.sum("l_quantity").alias("quantity"),
        F.sum("l_extendedprice").alias("gross_revenue"),
    )


def weekly_dashboard(events: DataFrame, ts: str = "ts", kind: str = "event_type", user: str = "user_id") -> DataFrame:
    """Per ISO week (Monday) and kind: events and distinct users."""
    week = F.to_date(F.date_trunc("week", F.col(ts).cast("timestamp")))
    return events.groupBy(week.alias("week"), kind).agg(
        F.count("*").alias("event_count"), F.countDistinct(user).alias("unique_users")
    )


def user_cohorts(events: DataFrame, user: str, ts: str) -> DataFrame:
    """First-month cohort by months since: active users.

    Users are reduced to their active months before the window, which then sees at
    most one row per user and month.
    """
    active = events.select(F.col(user).alias("_u"), month(F.col(ts)).alias("_m")).distinct()
    first = Window.partitionBy("_u")
    cohort = active.withColumn("cohort_month", F.min("_m").over(first))
    months = F.months_between("_m", "cohort_month").cast("int")
    return cohort.groupBy("cohort_month", months.alias("months_since")).agg(
        F.count("*").alias("active_users")
    )


def user_features(events: DataFrame, kinds: Sequence[str], user: str = "user_id", ts: str = "ts",
                  kind: str = "event_type", value: str = "value") -> DataFrame:
    """Per user: event counts per kind, value statistics, active days."""
    per_kind = [F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in kinds]
    return events.groupBy(user).agg(
        F.count("*").alias("n_events"),
        *per_kind,
        F.avg(value).alias("avg_value"),
        F.max(value).alias("max_value"),
        F.countDistinct(F.to_date(ts)).alias("active_days"),
    )


def product_features(lines: DataFrame) -> DataFrame:
    """Per product: mean price and quantity, return share, suppliers."""
    returned: Column = F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0))
    return lines.groupBy("l_partkey").agg(
        F.avg("l_extendedprice").alias("avg_price"),
        F.avg("l_quantity").alias("avg_quantity"),
        returned.alias("return_rate"),
        F.countDistinct("l_suppkey").alias("suppliers"),
    )


def session_features(sessions: DataFrame, user: str = "user_id") -> DataFrame:
    """Per user, from ``session_aggregated``: sessions, mean length and events."""
    return sessions.groupBy(user).agg(
        F.count("*").alias("sessions"),
        F.avg("duration_seconds").alias("avg_duration_seconds"),
        F.avg("event_count").alias("avg_events"),
    )


def register_views(spark: SparkSession, **frames: DataFrame) -> None:
    """Expose models to SQL as temporary views (nothing is materialised)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
