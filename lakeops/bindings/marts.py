"""Marts and feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.bindings.base import averaged, EVENTS_AS_OF, KINDS, query, raw_posts, raw_users, rounded, table
from lakeops.operators import metrics, scoring
from lakeops.plans import marts, pipelines
from lakeops.session import scratch_dir

AS_OF = EVENTS_AS_OF


@query(
    "a1_fct_user_posts",
    f"""SELECT c_custkey::INTEGER AS user_id, c_name AS user_name, lower(replace(c_name, '#', '')) AS username,
               lower(replace(c_name, '#', '')) || '@example.com' AS email,
               count(event_id) AS total_posts, avg(length(props)) AS avg_post_length,
               max(length(props))::INTEGER AS max_post_length, min(length(props))::INTEGER AS min_post_length,
               max(ts) AS last_post_loaded_at, TIMESTAMP '{AS_OF}' AS calculated_at
        FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1, 2, 3, 4""",
)
def user_posts(spark, sf):
    return pipelines.build_user_posts(raw_users(spark, sf), raw_posts(spark, sf), AS_OF)


@query("a1_grain_violations", "SELECT p_name, count(*) AS occurrences FROM part GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf):
    return marts.grain_violations(table(spark, sf, "part"), ["p_name"])


_SESSIONS = """
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY min(ts)) AS session_no, min(ts) AS session_start,
           max(ts) AS session_end, count(*) AS event_count, sum(value) AS total_value,
           (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS duration_seconds
    FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM (
            SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 1800000000 THEN 0 ELSE 1 END AS opens
            FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)))
    GROUP BY user_id, n"""


@query(
    "m1_session_aggregated",
    f"""SELECT user_id, session_no, session_start, session_end, event_count, round(total_value, 2) AS total_value,
               round(duration_seconds, 6) AS duration_seconds FROM ({_SESSIONS})""",
)
def _(spark, sf):
    return rounded(marts.session_aggregated(table(spark, sf, "events")), total_value=2, duration_seconds=6)


@query(
    "m2_user_activity",
    """SELECT user_id, count(*) AS event_count, count(DISTINCT event_type) AS event_types, count(DISTINCT ts::DATE) AS active_days,
              min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1""",
)
def _(spark, sf):
    return marts.user_activity(table(spark, sf, "events"))


@query(
    "m2_user_events",
    "SELECT user_id, event_type, count(*) AS event_count, round(sum(value), 2) AS total_value FROM events GROUP BY 1, 2",
)
def _(spark, sf):
    return rounded(marts.user_events(table(spark, sf, "events")), total_value=2)


@query(
    "m3_order_enriched",
    """SELECT o_orderkey, o_custkey, c_name, c_mktsegment, c_nationkey, o_orderdate, o_totalprice,
              coalesce(line_count, 0) AS line_count, total_quantity, round(net_amount, 4) AS net_amount
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey
       LEFT JOIN (SELECT l_orderkey, count(*) AS line_count, sum(l_quantity) AS total_quantity,
                         sum(l_extendedprice * (1 - l_discount)) AS net_amount FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def _(spark, sf):
    out = marts.order_enriched(table(spark, sf, "orders"), table(spark, sf, "customer"), table(spark, sf, "lineitem"))
    return rounded(out, net_amount=4)


@query(
    "m4_product_metrics",
    """SELECT p_partkey, p_name, p_brand, p_type, coalesce(n, 0) AS line_count, quantity, round(revenue, 4) AS revenue,
              round(avg_discount + 1e-9, 8) AS avg_discount
       FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n, sum(l_quantity) AS quantity,
                                   sum(l_extendedprice * (1 - l_discount)) AS revenue, avg(l_discount) AS avg_discount
                            FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""",
)
def _(spark, sf):
    out = marts.product_metrics(table(spark, sf, "part"), table(spark, sf, "lineitem"))
    return averaged(rounded(out, revenue=4), avg_discount=8)


@query(
    "m4_revenue_summary",
    """SELECT date_trunc('month', l_shipdate)::DATE AS month, l_returnflag, count(DISTINCT l_orderkey) AS orders,
              round(sum(l_extendedprice), 2) AS gross_revenue, round(sum(l_extendedprice * (1 - l_discount)), 4) AS net_revenue
       FROM lineitem GROUP BY 1, 2""",
)
def _(spark, sf):
    return rounded(marts.revenue_summary(table(spark, sf, "lineitem")), gross_revenue=2, net_revenue=4)


@query(
    "m5_dim_users",
    """SELECT c_custkey AS user_id, c_name AS user_name, c_mktsegment AS segment, n_name AS nation, r_name AS region
       FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def _(spark, sf):
    return marts.dim_users(table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "region"))


@query(
    "m5_dim_products",
    """SELECT DISTINCT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS product_type, p_size AS size
       FROM part""",
)
def _(spark, sf):
    return marts.dim_products(table(spark, sf, "part"))


@query(
    "m5_dim_dates",
    """SELECT d AS date, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month, day(d)::INTEGER AS day,
              weekofyear(d)::INTEGER AS iso_week, isodow(d)::INTEGER AS iso_weekday, isodow(d) > 5 AS is_weekend
       FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS d FROM orders)""",
)
def _(spark, sf):
    return marts.dim_dates(table(spark, sf, "orders"), "o_orderdate")


_DAILY = """SELECT ts::DATE AS date, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
                   round(sum(value), 2) AS total_value FROM events GROUP BY 1"""


@query("m6_fct_daily_metrics", _DAILY)
def _(spark, sf):
    return rounded(marts.fct_daily_metrics(table(spark, sf, "events")), total_value=2)


@query("m6_refresh_daily_metrics", _DAILY)
def _(spark, sf):
    events = table(spark, sf, "events")
    stale = marts.fct_daily_metrics(events.filter(F.col("ts") < "2024-01-20 12:00:00"))
    return rounded(marts.refresh_daily_metrics(stale, events, "2024-01-20"), total_value=2)


@query(
    "m6_monthly_summary",
    """SELECT date_trunc('month', l_shipdate)::DATE AS month, count(*) AS line_count, sum(l_quantity) AS quantity,
              round(sum(l_extendedprice), 2) AS gross_revenue FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    return rounded(marts.monthly_summary(table(spark, sf, "lineitem")), gross_revenue=2)


@query(
    "m6_weekly_dashboard",
    """SELECT date_trunc('week', ts)::DATE AS week, event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users
       FROM events GROUP BY 1, 2""",
)
def _(spark, sf):
    return marts.weekly_dashboard(table(spark, sf, "events"))


@query(
    "m7_user_cohorts",
    """WITH a AS (SELECT DISTINCT o_custkey AS u, date_trunc('month', o_orderdate)::DATE AS m FROM orders),
       c AS (SELECT u, m, min(m) OVER (PARTITION BY u) AS cohort_month FROM a)
       SELECT cohort_month, ((year(m) - year(cohort_month)) * 12 + month(m) - month(cohort_month))::INTEGER AS months_since,
              count(*) AS active_users FROM c GROUP BY 1, 2""",
)
def _(spark, sf):
    return marts.user_cohorts(table(spark, sf, "orders"), "o_custkey", "o_orderdate")


_KIND_COUNTS = ", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS n_{k}" for k in KINDS)


@query(
    "m8_user_features",
    f"""SELECT user_id, count(*) AS n_events, {_KIND_COUNTS}, round(avg(value) + 1e-9, 6) AS avg_value, max(value) AS max_value,
               count(DISTINCT ts::DATE) AS active_days FROM events GROUP BY 1""",
)
def _(spark, sf):
    return averaged(marts.user_features(table(spark, sf, "events"), KINDS), avg_value=6)


@query(
    "m8_product_features",
    """SELECT l_partkey, round(avg(l_extendedprice) + 1e-9, 6) AS avg_price, round(avg(l_quantity) + 1e-9, 8) AS avg_quantity,
              round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END) + 1e-9, 8) AS return_rate, count(DISTINCT l_suppkey) AS suppliers
       FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    out = marts.product_features(table(spark, sf, "lineitem"))
    return averaged(out, avg_price=6, avg_quantity=8, return_rate=8)


@query(
    "m8_session_features",
    f"""SELECT user_id, count(*) AS sessions, round(avg(duration_seconds) + 1e-9, 6) AS avg_duration_seconds,
               round(avg(event_count) + 1e-9, 8) AS avg_events FROM ({_SESSIONS}) GROUP BY 1""",
)
def _(spark, sf):
    out = marts.session_features(marts.session_aggregated(table(spark, sf, "events")))
    return averaged(out, avg_duration_seconds=6, avg_events=8)


@query("m8_feature_scoring")
def _(spark, sf):
    """Churn-style model: predicts whether a user's mean event value is above 50."""
    features = marts.user_features(table(spark, sf, "events"), KINDS)
    data = features.withColumn("high_value", (F.col("avg_value") > 50).cast("string"))
    inputs = ["n_events", "active_days", *[f"n_{k}" for k in KINDS]]
    model = scoring.train_forest(data, inputs, "high_value")
    return scoring.score(model, data, ["user_id"], inputs, "v1")


@query(
    "m8_feature_scores_hold",
    """WITH u AS (SELECT user_id, avg(value) > 50 AS high FROM events GROUP BY 1)
       SELECT count(*) AS rows, count(DISTINCT user_id) AS ids, count(*) AS likely,
              greatest(count(*) FILTER (WHERE high), count(*) FILTER (WHERE NOT high)) AS majority, true AS beats_majority FROM u""",
)
def _(spark, sf):
    features = marts.user_features(table(spark, sf, "events"), KINDS)
    data = features.withColumn("high_value", (F.col("avg_value") > 50).cast("string"))
    inputs = ["n_events", "active_days", *[f"n_{k}" for k in KINDS]]
    scored = scoring.score(scoring.train_forest(data, inputs, "high_value"), data, ["user_id"], inputs, "v1")
    most = data.groupBy("high_value").count().agg(F.max("count")).first()[0]
    return scored.join(data.select("user_id", "high_value"), "user_id").agg(
        F.count("*").alias("rows"), F.countDistinct("user_id").alias("ids"),
        F.count_if(F.col("probability").between(0.5 - 1e-9, 1 + 1e-9)).alias("likely"), F.lit(most).alias("majority"),
        (F.count_if(F.col("prediction") == F.col("high_value")) >= most).alias("beats_majority"))


@query(
    "a5_monthly_users_from_days",
    "SELECT date_trunc('month', ts)::DATE AS month, event_type, count(DISTINCT user_id) AS unique_users FROM events GROUP BY 1, 2",
)
def _(spark, sf):
    """Distinct users of a month from a written table of daily bitmaps."""
    path = scratch_dir(spark, "daily-users")
    metrics.daily_bitmaps(table(spark, sf, "events"), ["event_type"], "ts").write.partitionBy("date").parquet(path)
    days = spark.read.parquet(path)
    return metrics.distinct_users(days, F.trunc("date", "month").alias("month"), "event_type")
