"""Pricing and cost reports; line items play the billing table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.bindings.base import averaged, BILLING_AS_OF, BILLING_SQL, billing, query, rounded, table
from lakeops.bindings.relational import calls
from lakeops.operators import costs

AS_OF = BILLING_AS_OF
_B = f"({BILLING_SQL}) AS b"


@query(
    "a6_monthly_cost",
    f"""SELECT date_trunc('month', date)::DATE AS month, round(sum(total_cost), 2) AS total_monthly_cost
        FROM {_B} WHERE date >= DATE '{AS_OF}' - INTERVAL 3 MONTH
        GROUP BY 1 ORDER BY 1 DESC LIMIT 3""",
)
def _(spark, sf):
    return rounded(costs.monthly_cost(billing(spark, sf), AS_OF), total_monthly_cost=2)


@query(
    "a6_monthly_cost_by_service",
    f"""SELECT date_trunc('month', date)::DATE AS month, service, round(sum(total_cost), 2) AS total_monthly_cost
        FROM {_B} WHERE date >= DATE '{AS_OF}' - INTERVAL 120 MONTH GROUP BY 1, 2""",
)
def _(spark, sf):
    out = costs.monthly_cost(billing(spark, sf), AS_OF, months=120, by_service=True)
    return rounded(out, total_monthly_cost=2)


@query(
    "a7_service_breakdown",
    f"""SELECT service, round(sum(total_cost), 2) AS cost, count(DISTINCT resource) AS resource_count
        FROM {_B} WHERE date >= DATE '{AS_OF}' - INTERVAL 3650 DAY GROUP BY 1""",
)
def _(spark, sf):
    return rounded(costs.service_breakdown(billing(spark, sf), AS_OF, days=3650), cost=2)


@query(
    "a7_top_resources",
    f"""SELECT service, resource, round(sum(total_cost), 2) AS total_cost, round(avg(total_cost) + 1e-9, 6) AS avg_daily_cost
        FROM {_B} WHERE date >= DATE '{AS_OF}' - INTERVAL 3650 DAY
        GROUP BY 1, 2 ORDER BY sum(total_cost) DESC, 1, 2 LIMIT 10""",
)
def _(spark, sf):
    out = costs.top_resources(billing(spark, sf), AS_OF, days=3650)
    return averaged(rounded(out, total_cost=2), avg_daily_cost=6)


@query(
    "a8_daily_trend",
    f"""SELECT date::DATE AS date, service, round(sum(total_cost), 2) AS daily_cost
        FROM {_B} WHERE date >= DATE '{AS_OF}' - INTERVAL 30 DAY GROUP BY 1, 2""",
)
def _(spark, sf):
    return rounded(costs.daily_trend(billing(spark, sf), AS_OF), daily_cost=2)


@query(
    "a9_pivot_metrics",
    f"""SELECT resource,
               sum(CASE WHEN metric = 'requests' THEN quantity ELSE 0 END) AS total_requests,
               sum(CASE WHEN metric = 'cpu_time' THEN quantity ELSE 0 END) AS total_cpu_ms,
               round(sum(total_cost), 2) AS total_cost
        FROM {_B} WHERE date >= DATE '{AS_OF}' - INTERVAL 3650 DAY GROUP BY 1""",
)
def _(spark, sf):
    wanted = {"total_requests": "requests", "total_cpu_ms": "cpu_time"}
    return rounded(costs.pivot_metrics(billing(spark, sf), AS_OF, wanted, days=3650), total_cost=2)


@query(
    "a10_unit_cost",
    f"""SELECT resource, round(sum(total_cost) / nullif(sum(quantity), 0) * 1000, 6) AS cost_per_1k_requests
        FROM {_B} WHERE metric = 'requests' AND date >= DATE '{AS_OF}' - INTERVAL 3650 DAY
        GROUP BY 1 HAVING sum(quantity) > 1000
        ORDER BY sum(total_cost) / nullif(sum(quantity), 0) DESC, 1 LIMIT 10""",
)
def _(spark, sf):
    out = costs.unit_cost(billing(spark, sf), AS_OF, days=3650, metric="requests")
    return rounded(out, cost_per_1k_requests=6)


@query(
    "a10_cost_per_request",
    f"""SELECT resource, round(sum(total_cost) / nullif(sum(quantity), 0), 6) AS cost_per_request
        FROM {_B} WHERE metric = 'requests' GROUP BY 1""",
)
def _(spark, sf):
    out = costs.unit_cost(
        billing(spark, sf), scale=1.0, min_quantity=None, limit=None, metric="requests", out="cost_per_request"
    )
    return rounded(out, cost_per_request=6)


@query(
    "a16_usage_cost",
    """SELECT ts::DATE AS date, 'Workers' AS service, event_type AS resource, 'requests' AS metric,
              count(*)::DOUBLE AS quantity, 0.5::DOUBLE AS unit_cost,
              round(count(*) / 1e6 * 0.5 + sum(value) / 1000 / 1e6 * 0.02, 10) AS total_cost, 'USD' AS currency
       FROM events GROUP BY 1, 3
       UNION ALL
       SELECT DATE '2024-01-31', 'R2', source, 'storage_gb', round(sum(n_chars) / 1e9, 10), 0.015::DOUBLE,
              round(sum(n_chars) / 1e9 * 0.015 / 30, 10), 'USD'
       FROM documents GROUP BY 3""",
)
def _(spark, sf):
    usage = table(spark, sf, "events").groupBy(
        F.to_date("ts").alias("date"), F.col("event_type").alias("worker_name")
    ).agg(F.count("*").alias("requests"), F.sum("value").alias("total_cpu_time_ms"))
    buckets = table(spark, sf, "documents").groupBy(F.col("source").alias("name")).agg(
        F.sum("n_chars").alias("size_bytes")
    ).withColumn("date", F.lit("2024-01-31").cast("date"))
    return rounded(costs.usage_cost(usage, buckets), quantity=10, total_cost=10)


@query(
    "a17_token_cost_daily",
    """WITH w AS (SELECT (DATE '2024-01-01' + turn::INTEGER)::DATE AS date, role, len(string_split(text, ' ')) AS n
                  FROM conversations),
       d AS (SELECT date, sum(CASE WHEN role = 'assistant' THEN 0 ELSE n END)::BIGINT AS prompt_tokens,
                    sum(CASE WHEN role = 'assistant' THEN n ELSE 0 END)::BIGINT AS completion_tokens
             FROM w GROUP BY 1)
       SELECT *, round(prompt_tokens / 1000 * 0.0015 + completion_tokens / 1000 * 0.002, 4) AS estimated_cost_usd
       FROM d""",
)
def _(spark, sf):
    return costs.token_cost_daily(calls(spark, sf), "timestamp", "prompt_tokens", "completion_tokens")


@query(
    "a18_tiered_monthly_cost",
    """WITH u AS (
         SELECT c_custkey, c_mktsegment, coalesce(sum(o_totalprice), 0) AS spend, count(o_orderkey) AS n
         FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2),
       p AS (
         SELECT c_custkey,
                CASE c_mktsegment WHEN 'BUILDING' THEN 'free' WHEN 'MACHINERY' THEN 'unbound' ELSE 'bundled' END AS plan,
                round(spend, 0) * 10 AS req, n * 5 AS r2, n * 100 AS minutes
         FROM u),
       c AS (
         SELECT c_custkey, plan,
                CASE plan WHEN 'free' THEN 0 WHEN 'bundled' THEN 5 ELSE 25 END AS fixed,
                greatest(0, (req - CASE plan WHEN 'free' THEN 3000000 WHEN 'bundled' THEN 10000000 ELSE 1000000 END)
                            / 1000000 * 0.5) AS workers,
                greatest(0, (r2 - 10) * 0.015) AS storage,
                greatest(0, (minutes - 2000) / 1000 * 8.0) AS ci
         FROM p)
       SELECT c_custkey, plan AS workers_plan, fixed::DOUBLE AS fixed_cost, round(workers, 6) AS workers_requests_cost,
              round(storage::DOUBLE, 6) AS r2_storage_gb_cost, round(ci::DOUBLE, 6) AS github_actions_minutes_cost,
              round((workers + storage + ci)::DOUBLE, 6) AS variable_cost,
              round((fixed + workers + storage + ci)::DOUBLE, 6) AS total
       FROM c""",
)
def _(spark, sf):
    spend = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("o_totalprice").alias("spend"), F.count("*").alias("n")
    )
    n = F.coalesce("n", F.lit(0))
    usage = table(spark, sf, "customer").join(spend, "c_custkey", "left").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", "free")
        .when(F.col("c_mktsegment") == "MACHINERY", "unbound")
        .otherwise("bundled")
        .alias("workers_plan"),
        (F.round(F.coalesce("spend", F.lit(0.0)), 0) * 10).alias("workers_requests_per_month"),
        (n * 5).alias("r2_storage_gb"),
        (n * 100).alias("github_actions_minutes"),
    )
    shown = [
        "workers_requests_cost", "r2_storage_gb_cost", "github_actions_minutes_cost", "variable_cost", "total",
    ]
    out = costs.tiered_monthly_cost(usage).select("c_custkey", "workers_plan", "fixed_cost", *shown)
    return rounded(out, **{c: 6 for c in shown})


@query(
    "w1_month_to_date",
    f"""WITH f AS (SELECT date::DATE AS date, service, resource, total_cost FROM {_B}
                   WHERE date >= DATE '{AS_OF}' - INTERVAL 30 DAY)
        SELECT date, service, resource, total_cost,
               round(sum(total_cost) OVER (PARTITION BY date_trunc('month', date) ORDER BY date), 2) AS month_to_date_cost
        FROM f""",
)
def _(spark, sf):
    return rounded(costs.month_to_date(billing(spark, sf), AS_OF), month_to_date_cost=2)


@query(
    "w1_month_to_date_full_history",
    f"""WITH f AS (SELECT date::DATE AS date, service, resource, total_cost,
                          sum(total_cost) OVER (PARTITION BY date_trunc('month', date) ORDER BY date::DATE) AS s FROM {_B})
        SELECT date, service, resource, total_cost, round(s, 2) AS month_to_date_cost
        FROM f WHERE date >= DATE '{AS_OF}' - INTERVAL 3650 DAY""",
)
def _(spark, sf):
    out = costs.month_to_date(billing(spark, sf), AS_OF, days=3650, full_history=True)
    return rounded(out, month_to_date_cost=2)


_ANOMALIES = """
    WITH d AS (SELECT date::DATE AS date, service, resource, sum(total_cost) AS total_cost FROM {rows} GROUP BY 1, 2, 3),
    c AS (SELECT *, lag(total_cost) OVER (PARTITION BY service, resource ORDER BY date) AS prev_cost FROM d),
    p AS (SELECT *, (total_cost - prev_cost) / nullif(prev_cost, 0) * 100 AS pct_change FROM c)
    SELECT date, service, resource, round(total_cost, 2) AS total_cost, round(prev_cost, 2) AS prev_cost,
           round(pct_change, 6) AS pct_change
    FROM p WHERE abs(pct_change) > 50 {tail}"""


@query(
    "w2_cost_anomalies",
    _ANOMALIES.format(
        rows=f"{_B} WHERE date >= DATE '{AS_OF}' - INTERVAL 7 DAY",
        tail="ORDER BY abs(p.pct_change) DESC, date, service, resource LIMIT 5",
    ),
)
def _(spark, sf):
    out = costs.cost_anomalies(billing(spark, sf), AS_OF)
    return rounded(out, total_cost=2, prev_cost=2, pct_change=6)


@query(
    "w2_cost_anomalies_full_history",
    _ANOMALIES.format(rows=_B, tail=f"AND date >= DATE '{AS_OF}' - INTERVAL 3650 DAY"),
)
def _(spark, sf):
    out = costs.cost_anomalies(billing(spark, sf), AS_OF, days=3650, limit=None, full_history=True)
    return rounded(out, total_cost=2, prev_cost=2, pct_change=6)


@query(
    "w3_cost_forecast",
    f"""WITH d AS (SELECT date::DATE AS date, sum(total_cost) AS c FROM {_B}
                   WHERE date >= DATE '{AS_OF}' - INTERVAL 30 DAY GROUP BY 1),
        r AS (SELECT row_number() OVER (ORDER BY date) AS i,
                     avg(c) OVER (ORDER BY date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS p FROM d)
        SELECT (DATE '{AS_OF}' + i::INTEGER)::DATE AS forecast_date, round(p, 4) AS predicted_cost FROM r WHERE i <= 7""",
)
def _(spark, sf):
    return rounded(costs.cost_forecast(billing(spark, sf), AS_OF), predicted_cost=4)


@query(
    "w4_spend_alert",
    f"""WITH d AS (SELECT date::DATE AS date, sum(total_cost) AS c FROM {_B} GROUP BY 1)
        SELECT round(coalesce(sum(c) FILTER (WHERE date = DATE '2001-07-01'), 0), 2) AS today_cost,
               round(avg(c) + 1e-9, 4) AS average_cost,
               coalesce(sum(c) FILTER (WHERE date = DATE '2001-07-01'), 0) > avg(c) * 1.5 AS alert FROM d""",
)
def _(spark, sf):
    return averaged(rounded(costs.spend_alert(billing(spark, sf), "2001-07-01"), today_cost=2), average_cost=4)


@query(
    "w5_projected_spend",
    f"""SELECT round(sum(total_cost), 2) AS current_spend, round(sum(total_cost) * 30 / 20, 2) AS projected,
               sum(total_cost) * 30 / 20 > 1000000 AS alert
        FROM {_B} WHERE date >= DATE '2001-07-01' AND date < DATE '2001-07-21'""",
)
def _(spark, sf):
    out = costs.projected_spend(billing(spark, sf), "2001-07-20", budget=1_000_000)
    return rounded(out, current_spend=2, projected=2)
