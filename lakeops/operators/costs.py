"""Usage pricing and cost analytics over billing rows.

Billing rows: ``date, service, resource, metric, quantity, unit_cost,
total_cost, currency``.

Windows run on daily sums, never on raw rows: a month or resource that holds a
third of all rows is reduced to one row per day before it is ordered.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.functions.casts import ratio
from lakeops.functions.timeparts import (
    Moment,
    before,
    moment,
    month,
    months_before,
    not_before,
    since,
)

# Unit prices in USD.
USD_PER_MILLION_REQUESTS = 0.50
USD_PER_MILLION_CPU_SECONDS = 0.02
USD_PER_GB_MONTH = 0.015
USD_PER_1K_PROMPT_TOKENS = 0.0015
USD_PER_1K_COMPLETION_TOKENS = 0.002
BILLING_DAYS_PER_MONTH = 30

# Plan -> (monthly fee, included requests).
PLANS = {
    "free": (0.0, 3_000_000),
    "bundled": (5.0, 10_000_000),
    "unbound": (25.0, 1_000_000),
}

# Usage column -> (free allowance, units per price, price in USD).
TIERS = {
    "r2_storage_gb": (10, 1, 0.015),
    "d1_storage_gb": (5, 1, 0.75),
    "d1_read_rows": (750_000_000, 1_000_000, 0.001),
    "d1_write_rows": (1_500_000, 1_000_000, 1.0),
    "kv_storage_gb": (1, 1, 0.5),
    "kv_reads": (300_000_000, 1_000_000, 0.5),
    "kv_writes": (30_000_000, 1_000_000, 5.0),
    "analytics_engine_writes": (10_000_000, 1_000_000, 0.25),
    "github_actions_minutes": (2_000, 1_000, 8.0),
}

# Usage assumed where a column is absent or NULL.
USAGE_DEFAULTS = {
    "d1_storage_gb": 1,
    "d1_read_rows": 1_000_000,
    "d1_write_rows": 10_000,
    "kv_storage_gb": 0.1,
    "kv_reads": 100_000,
    "kv_writes": 1_000,
    "analytics_engine_writes": 100_000,
    "workers_plan": "free",
    "github_actions_minutes": 0,
}


# ---------------------------------------------------------------- pricing

def worker_billing(usage: DataFrame) -> DataFrame:
    """Billing rows from ``date, worker_name, requests, total_cpu_time_ms``."""
    cost = F.col("requests") / 1_000_000 * USD_PER_MILLION_REQUESTS + (
        F.col("total_cpu_time_ms") / 1000 / 1_000_000 * USD_PER_MILLION_CPU_SECONDS
    )
    return _billing_rows(
        usage, "Workers", F.col("worker_name"), "requests", F.col("requests"),
        USD_PER_MILLION_REQUESTS, cost,
    )


def storage_billing(buckets: DataFrame) -> DataFrame:
    """Billing rows (one day's share) from ``date, name, size_bytes``."""
    gigabytes = F.col("size_bytes") / 1_000_000_000
    return _billing_rows(
        buckets, "R2", F.col("name"), "storage_gb", gigabytes, USD_PER_GB_MONTH,
        gigabytes * USD_PER_GB_MONTH / BILLING_DAYS_PER_MONTH,
    )


def _billing_rows(df, service, resource, metric, quantity, unit_cost, cost) -> DataFrame:
    return df.select(
        F.col("date").cast("date").alias("date"),
        F.lit(service).alias("service"),
        resource.cast("string").alias("resource"),
        F.lit(metric).alias("metric"),
        quantity.cast("double").alias("quantity"),
        F.lit(unit_cost).alias("unit_cost"),
        cost.cast("double").alias("total_cost"),
        F.lit("USD").alias("currency"),
    )


def usage_cost(usage: DataFrame, buckets: DataFrame) -> DataFrame:
    """All priced rows of both services."""
    return worker_billing(usage).unionByName(storage_billing(buckets))


def token_cost_daily(
    calls: DataFrame, ts: str, prompt_tokens: str, completion_tokens: str,
    prompt_rate: float = USD_PER_1K_PROMPT_TOKENS,
    completion_rate: float = USD_PER_1K_COMPLETION_TOKENS,
) -> DataFrame:
    """Estimated model cost per UTC day, at four decimals.

    Tokens are summed as integers and priced once per day, so the result does
    not depend on the order in which rows are added.
    """
    return (
        calls.groupBy(F.to_date(F.col(ts)).alias("date"))
        .agg(
            F.coalesce(F.sum(F.col(prompt_tokens).cast("bigint")), F.lit(0)).alias("prompt_tokens"),
            F.coalesce(F.sum(F.col(completion_tokens).cast("bigint")), F.lit(0)).alias(
                "completion_tokens"
            ),
        )
        .withColumn(
            "estimated_cost_usd",
            F.round(
                F.col("prompt_tokens") / 1000 * prompt_rate
                + F.col("completion_tokens") / 1000 * completion_rate,
                4,
            ),
        )
    )


def tiered_monthly_cost(usage: DataFrame) -> DataFrame:
    """Monthly bill per account: fixed plan fee plus usage above the free tiers.

    Input: one row per account with ``workers_requests_per_month``,
    ``r2_storage_gb`` and any of ``USAGE_DEFAULTS``. Other columns are kept.
    Adds ``<usage column>_cost`` per tier, ``workers_requests_cost``,
    ``fixed_cost``, ``variable_cost``, ``total`` and a ``breakdown`` struct.
    An unknown plan gives NULL costs.
    """
    filled = usage
    for name, default in USAGE_DEFAULTS.items():
        present = [F.col(name)] if name in usage.columns else []
        filled = filled.withColumn(name, F.coalesce(*present, F.lit(default)))

    def plan_value(i: int) -> Column:
        out = F.lit(None).cast("double")
        for plan, values in PLANS.items():
            out = F.when(F.col("workers_plan") == plan, F.lit(float(values[i]))).otherwise(out)
        return out

    def above(name: str, free: Column | int, unit: int, price: float) -> Column:
        over = (F.col(name) - free) / F.lit(unit) * F.lit(price)
        # greatest() skips NULL, which would turn an unknown plan into 0
        return F.when(over.isNotNull(), F.greatest(F.lit(0.0), over.cast("double")))

    priced = filled.withColumns(
        {
            "fixed_cost": plan_value(0),
            "workers_requests_cost": above("workers_requests_per_month", plan_value(1), 1_000_000, 0.5),
            **{f"{n}_cost": above(n, *tier) for n, tier in TIERS.items()},
        }
    )
    col = lambda n: F.col(f"{n}_cost")
    service = {
        "workers": col("workers_requests"),
        "r2": col("r2_storage_gb"),
        "d1": col("d1_storage_gb") + col("d1_read_rows") + col("d1_write_rows"),
        "kv": col("kv_storage_gb") + col("kv_reads") + col("kv_writes"),
        "analytics_engine": col("analytics_engine_writes"),
        "github_actions": col("github_actions_minutes"),
    }
    variable = sum(list(service.values())[1:], service["workers"])
    totals = {n: (c + F.col("fixed_cost") if n == "workers" else c) for n, c in service.items()}
    breakdown = F.struct(*[c.alias(n) for n, c in totals.items()])
    return priced.withColumns({"variable_cost": variable, "breakdown": breakdown}).withColumn(
        "total", F.col("fixed_cost") + F.col("variable_cost")
    )


# ---------------------------------------------------------------- reports

def _recent(billing: DataFrame, as_of: Moment | None, days: int) -> DataFrame:
    return billing if as_of is None else billing.filter(since(billing, "date", as_of, days=days))


def monthly_cost(
    billing: DataFrame, as_of: Moment, months: int = 3, by_service: bool = False
) -> DataFrame:
    """Cost per month (and service) over the last ``months``, newest first.

    Without the service key at most ``months`` rows are returned.
    """
    start = months_before(moment(as_of).date(), months)
    keys = [month(F.col("date")).alias("month")] + ([F.col("service")] if by_service else [])
    out = (
        billing.filter(not_before(billing, "date", start))
        .groupBy(*keys)
        .agg(F.sum("total_cost").alias("total_monthly_cost"))
    )
    if by_service:
        return out.orderBy(F.desc("month"), "service")
    return out.orderBy(F.desc("month")).limit(months)


def service_breakdown(billing: DataFrame, as_of: Moment, days: int = 30) -> DataFrame:
    """Per service: cost and number of distinct resources, highest cost first."""
    return (
        _recent(billing, as_of, days)
        .groupBy("service")
        .agg(
            F.sum("total_cost").alias("cost"), F.countDistinct("resource").alias("resource_count")
        )
        .orderBy(F.desc("cost"), "service")
    )


def top_resources(billing: DataFrame, as_of: Moment, days: int = 30, limit: int = 10) -> DataFrame:
    """The most expensive resources with total and mean cost per billing row."""
    return (
        _recent(billing, as_of, days)
        .groupBy("service", "resource")
        .agg(F.sum("total_cost").alias("total_cost"), F.avg("total_cost").alias("avg_daily_cost"))
        .orderBy(F.desc("total_cost"), "service", "resource")
        .limit(limit)
    )


def daily_trend(billing: DataFrame, as_of: Moment, days: int = 30) -> DataFrame:
    return (
        _recent(billing, as_of, days)
        .groupBy(F.to_date("date").alias("date"), "service")
        .agg(F.sum("total_cost").alias("daily_cost"))
        .orderBy("date", "service")
    )


def pivot_metrics(
    billing: DataFrame, as_of: Moment, metrics: dict[str, str], service: str | None = None,
    days: int = 30,
) -> DataFrame:
    """Per resource: one quantity sum per metric (``output name -> metric``) and the cost."""
    rows = _recent(billing, as_of, days)
    if service is not None:
        rows = rows.filter(F.col("service") == service)
    sums = [
        F.sum(F.when(F.col("metric") == metric, F.col("quantity")).otherwise(F.lit(0.0))).alias(out)
        for out, metric in metrics.items()
    ]
    return (
        rows.groupBy("resource")
        .agg(*sums, F.sum("total_cost").alias("total_cost"))
        .orderBy(F.desc("total_cost"), "resource")
    )


def unit_cost(
    billing: DataFrame, as_of: Moment | None = None, days: int = 30, scale: float = 1000.0,
    min_quantity: float | None = 1000.0, limit: int | None = 10, service: str | None = None,
    metric: str | None = None, out: str = "cost_per_1k_requests",
) -> DataFrame:
    """Cost per ``scale`` units of quantity per resource, highest first.

    Resources with at most ``min_quantity`` are left out; a zero quantity gives NULL.
    """
    rows = _recent(billing, as_of, days)
    for column, wanted in (("service", service), ("metric", metric)):
        if wanted is not None:
            rows = rows.filter(F.col(column) == wanted)
    sums = rows.groupBy("resource").agg(F.sum("total_cost").alias("_c"), F.sum("quantity").alias("_q"))
    if min_quantity is not None:
        sums = sums.filter(F.col("_q") > min_quantity)
    priced = sums.select("resource", (ratio(F.col("_c"), F.col("_q")) * scale).alias(out))
    priced = priced.orderBy(F.desc(out), "resource")
    return priced if limit is None else priced.limit(limit)


# ---------------------------------------------------------------- windows

def month_to_date(
    billing: DataFrame, as_of: Moment, days: int = 30, full_history: bool = False
) -> DataFrame:
    """Every billing row with the running cost of its month up to its date.

    Rows of one date share a value. By default rows older than ``days`` are
    dropped before the running sum (the oldest month is then partial);
    ``full_history`` sums first. The sum runs over days and is joined back by
    date, so a month's rows never meet in one task.
    """
    rows = billing.withColumn("date", F.to_date("date"))
    base = rows if full_history else _recent(rows, as_of, days)
    running = Window.partitionBy(month(F.col("date"))).orderBy("date")
    days_ = (
        base.groupBy("date")
        .agg(F.sum("total_cost").alias("_day"))
        .select("date", F.sum("_day").over(running).alias("month_to_date_cost"))
    )
    shown = _recent(rows, as_of, days)
    # one row per calendar day, a few thousand per decade: safe to send everywhere
    return shown.join(F.broadcast(days_), "date", "left").select(
        "date", "service", "resource", "total_cost", "month_to_date_cost"
    )


def cost_anomalies(
    billing: DataFrame, as_of: Moment, days: int = 7, threshold_pct: float = 50.0,
    limit: int | None = 5, full_history: bool = False,
) -> DataFrame:
    """Resources whose daily cost moved by more than ``threshold_pct`` against
    their previous day with cost, largest change first.

    Costs are summed per day and resource first; a previous cost of 0 gives no
    percentage. By default older rows are dropped before the comparison, so the
    first day shown has no predecessor; ``full_history`` compares first.
    """
    rows = billing.withColumn("date", F.to_date("date"))
    base = rows if full_history else _recent(rows, as_of, days)
    daily = base.groupBy("date", "service", "resource").agg(F.sum("total_cost").alias("total_cost"))
    along = Window.partitionBy("service", "resource").orderBy("date")
    compared = daily.withColumn("prev_cost", F.lag("total_cost").over(along)).withColumn(
        "pct_change", ratio(F.col("total_cost") - F.col("prev_cost"), F.col("prev_cost")) * 100
    )
    if full_history:
        compared = _recent(compared, as_of, days)
    moved = compared.filter(F.abs("pct_change") > threshold_pct).orderBy(
        F.desc(F.abs("pct_change")), "date", "service", "resource"
    )
    return moved if limit is None else moved.limit(limit)


def cost_forecast(
    billing: DataFrame, as_of: Moment, days: int = 30, horizon: int = 7, full_history: bool = False
) -> DataFrame:
    """Trailing mean of daily cost, dated forward from ``as_of``.

    The frame is the day and the 7 days before it, so up to 8 values. Row i of
    the daily series (by date) is shown as the forecast for ``as_of + i``; the
    first ``horizon`` rows are returned. One row per day reaches the window.
    """
    rows = billing if full_history else _recent(billing, as_of, days)
    daily = rows.groupBy(F.to_date("date").alias("date")).agg(F.sum("total_cost").alias("_day"))
    by_date = Window.orderBy("date")
    start = F.lit(moment(as_of).date().isoformat()).cast("date")
    return (
        daily.select(
            F.row_number().over(by_date).alias("_i"),
            F.avg("_day").over(by_date.rowsBetween(-7, 0)).alias("predicted_cost"),
        )
        .filter(F.col("_i") <= horizon)
        .select(F.date_add(start, F.col("_i")).alias("forecast_date"), "predicted_cost")
    )


def spend_alert(billing: DataFrame, today: Moment, factor: float = 1.5) -> DataFrame:
    """One row: today's cost, mean daily cost and whether today is above ``factor`` times it."""
    daily = billing.groupBy(F.to_date("date").alias("date")).agg(F.sum("total_cost").alias("_day"))
    is_today = F.col("date") == F.lit(moment(today).date().isoformat()).cast("date")
    return daily.agg(
        F.coalesce(F.sum(F.when(is_today, F.col("_day"))), F.lit(0.0)).alias("today_cost"),
        F.avg("_day").alias("average_cost"),
    ).withColumn(
        "alert", F.coalesce(F.col("today_cost") > F.col("average_cost") * factor, F.lit(False))
    )


def projected_spend(billing: DataFrame, as_of: Moment, budget: float) -> DataFrame:
    """One row: spend of the running month, its projection to 30 days, over budget or not."""
    now = moment(as_of)
    first = now.date().replace(day=1)
    tomorrow = now.date() + dt.timedelta(days=1)
    return (
        billing.filter(not_before(billing, "date", first) & before(billing, "date", tomorrow))
        .agg(F.coalesce(F.sum("total_cost"), F.lit(0.0)).alias("current_spend"))
        .withColumn("projected", F.col("current_spend") * BILLING_DAYS_PER_MONTH / now.day)
        .withColumn("alert", F.col("projected") > F.lit(float(budget)))
    )
