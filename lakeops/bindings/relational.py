"""Staging, joins, counting, merging, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.bindings.base import (
    averaged,
    EVENTS_AS_OF,
    POSTS_SQL,
    USERS_SQL,
    query,
    raw_posts,
    raw_users,
    rounded,
    table,
)
from lakeops.functions.casts import lenient_double, lenient_long
from lakeops.operators import joins, merge, metrics, ordered, staging
from lakeops.session import scratch_dir
from lakeops.sources import readers

AS_OF = EVENTS_AS_OF


# ------------------------------------------------------- scans and projections

@query("s1_read_layer", "SELECT * FROM events")
def _(spark, sf):
    return readers.read_layer(spark, sf, "events.parquet")


@query("s7_sample_rows")
def _(spark, sf):
    return readers.sample_rows(table(spark, sf, "orders"), 100, seed=7)


@query("s8_file_inventory")
def _(spark, sf):
    return readers.file_inventory(table(spark, sf, "lineitem"), "raw", threshold_bytes=10**12)


@query(
    "s7_sample_is_contained",
    "SELECT least(count(*), 100) AS rows, least(count(*), 100) AS distinct_rows, least(count(*), 100) AS contained FROM orders",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    taken = readers.sample_rows(orders, 100, seed=7).withColumn("taken", F.lit(1))
    both = taken.select(F.struct(*orders.columns).alias("row"), "taken").join(
        orders.select(F.struct(*orders.columns).alias("row"), F.lit(1).alias("there")), "row", "left")
    return both.agg(F.sum("taken").alias("rows"), F.countDistinct("row").alias("distinct_rows"), F.sum("there").alias("contained"))


@query("s8_inventory_of_written", "SELECT 'raw' AS layer, count(DISTINCT o_orderstatus) AS object_count, true AS some_bytes, true AS over_threshold FROM orders")
def _(spark, sf):
    path = scratch_dir(spark, "inventory")
    table(spark, sf, "orders").repartition("o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    found = readers.file_inventory(spark.read.parquet(path), "raw", threshold_bytes=1)
    return found.select("layer", "object_count", (F.col("total_bytes") > 100).alias("some_bytes"), "over_threshold")


@query("p1_stage_posts", POSTS_SQL)
def _(spark, sf):
    return staging.stage_posts(raw_posts(spark, sf))


@query("p2_stage_users", USERS_SQL)
def _(spark, sf):
    return staging.stage_users(raw_users(spark, sf))


@query(
    "p3_clean_rows",
    """SELECT o_orderkey AS id, trim(o_orderpriority) AS name,
              o_totalprice::DECIMAL(10,2)::DOUBLE AS amount
       FROM orders WHERE o_orderkey IS NOT NULL AND o_totalprice IS NOT NULL""",
)
def _(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("name"),
        F.col("o_totalprice").alias("amount"),
    )
    return staging.clean_rows(raw).withColumn("amount", F.col("amount").cast("double"))


@query(
    "p4_categorize_events",
    """SELECT ts AS timestamp, user_id, event_type AS action, props AS properties,
              CASE WHEN event_type = 'purchase' THEN 'conversion'
                   WHEN event_type = 'add_to_cart' THEN 'engagement' ELSE 'other' END AS event_category
       FROM events WHERE event_type IS NOT NULL AND user_id IS NOT NULL""",
)
def _(spark, sf):
    return staging.categorize_events(clicks(spark, sf))


def clicks(spark, sf):
    return table(spark, sf, "events").select(
        F.col("ts").alias("timestamp"), "user_id", F.col("event_type").alias("action"),
        F.col("props").alias("properties"),
    )


@query(
    "p5_lenient_cast",
    r"""SELECT o_orderkey,
               CASE WHEN regexp_full_match(split_part(o_orderpriority, '-', 1), '[+-]?[0-9]+')
                    THEN split_part(o_orderpriority, '-', 1)::BIGINT ELSE 0 END AS priority,
               CASE WHEN regexp_full_match(o_orderpriority, '[+-]?[0-9]+')
                    THEN o_orderpriority::BIGINT ELSE 0 END AS bad_long,
               o_totalprice AS price,
               0.0::DOUBLE AS bad_double
        FROM orders""",
)
def _(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        lenient_long(F.split_part("o_orderpriority", F.lit("-"), F.lit(1))).alias("priority"),
        lenient_long(F.col("o_orderpriority")).alias("bad_long"),
        lenient_double(F.col("o_totalprice").cast("string")).alias("price"),
        lenient_double(F.col("o_orderpriority")).alias("bad_double"),
    )


@query(
    "p5_lenient_cast_lines",
    r"""SELECT l_linenumber,
               CASE WHEN regexp_full_match(l_orderkey::VARCHAR, '[+-]?[0-9]+') THEN l_orderkey ELSE 0 END AS order_key,
               CASE WHEN regexp_full_match(l_returnflag, '[+-]?[0-9]+') THEN l_returnflag::BIGINT ELSE 0 END AS bad_long,
               l_extendedprice AS price, l_quantity AS quantity
        FROM lineitem""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select(
        "l_linenumber",
        lenient_long(F.col("l_orderkey").cast("string")).alias("order_key"),
        lenient_long(F.col("l_returnflag")).alias("bad_long"),
        lenient_double(F.col("l_extendedprice").cast("string")).alias("price"),
        lenient_double(F.col("l_quantity").cast("string")).alias("quantity"),
    )


@query(
    "p6_time_range",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY",
)
def _(spark, sf):
    return staging.time_range(table(spark, sf, "events"), "ts", AS_OF, days=7)


@query("p7_dedup_rows", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, sf):
    return staging.dedup_rows(table(spark, sf, "events"), ["user_id", "event_type"])


# ------------------------------------------------------- joins

@query(
    "j3_lookup_by_ids",
    "SELECT * FROM customer WHERE c_custkey IN (SELECT user_id FROM events)",
)
def _(spark, sf):
    ids = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    c = table(spark, sf, "customer")
    return joins.lookup_by_ids(c, ids, "c_custkey").select(*c.columns)


@query(
    "j3_missing_ids",
    "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def _(spark, sf):
    return joins.missing_ids(table(spark, sf, "labels"), table(spark, sf, "documents"), "doc_id")


@query(
    "j4_enrich",
    """SELECT d.doc_id, d.lang, d.source, l.quality AS label_quality, l.toxic AS label_toxic
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return joins.enrich(docs, table(spark, sf, "labels"), ["doc_id"], prefix="label_")


@query(
    "j6_referential_integrity",
    """SELECT count(*) AS element_count,
              count(*) FILTER (WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) AS unexpected_count,
              count(*) FILTER (WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) = 0 AS success
       FROM lineitem WHERE l_partkey IS NOT NULL""",
)
def _(spark, sf):
    return joins.referential_integrity(
        table(spark, sf, "lineitem"), table(spark, sf, "part"), "l_partkey", "p_partkey"
    )


@query(
    "j6_orphans",
    "SELECT doc_id, quality, toxic FROM labels WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)",
)
def _(spark, sf):
    return joins.orphans(table(spark, sf, "labels"), table(spark, sf, "embeddings"), "doc_id", "vec_id")


# ------------------------------------------------------- aggregates

@query(
    "a2_daily_metrics",
    """SELECT ts::DATE AS date, count(*) AS total_records, round(sum(value), 2) AS total_amount
       FROM events GROUP BY 1""",
)
def _(spark, sf):
    return rounded(metrics.daily_metrics(table(spark, sf, "events"), "ts", "value"), total_amount=2)


@query(
    "a3_daily_events",
    "SELECT ts::DATE AS event_date, event_type, count(*) AS event_count FROM events GROUP BY 1, 2",
)
def _(spark, sf):
    return metrics.daily_events(table(spark, sf, "events"), "ts")


@query(
    "a4_events_by_type",
    """SELECT event_type, count(*) AS event_count, round(avg(value) + 1e-9, 6) AS avg_value
       FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY GROUP BY 1""",
)
def _(spark, sf):
    out = metrics.events_by_type(table(spark, sf, "events"), AS_OF, ts="ts")
    return averaged(out, avg_value=6)


@query(
    "a5_hourly_categories",
    """SELECT date_trunc('hour', ts) AS hour,
              CASE WHEN event_type = 'purchase' THEN 'conversion' ELSE 'other' END AS event_category,
              count(*) AS event_count, count(DISTINCT user_id) AS unique_users
       FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 720 HOUR GROUP BY 1, 2""",
)
def _(spark, sf):
    return metrics.hourly_categories(staging.categorize_events(clicks(spark, sf)), AS_OF, hours=720)


@query(
    "a11_run_stats",
    """SELECT event_type AS flow_name, ts::DATE AS date, count(*) AS total_runs,
              count(*) FILTER (WHERE event_type <> 'error') AS successful,
              count(*) FILTER (WHERE event_type = 'error') AS failed,
              round(avg(date_diff('second', ts, ts + to_microseconds((value * 1000000)::BIGINT))) + 1e-9, 6)
                AS avg_duration_seconds
       FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY GROUP BY 1, 2""",
)
def _(spark, sf):
    micros = F.round(F.col("value") * 1_000_000).cast("bigint")
    end = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + micros)
    runs = table(spark, sf, "events").select(
        F.col("event_type").alias("flow_name"),
        F.col("ts").alias("start_time"),
        end.alias("end_time"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("COMPLETED").alias("status"),
    )
    return averaged(metrics.run_stats(runs, AS_OF), avg_duration_seconds=6)


def calls(spark, sf):
    """Conversation turns as model calls: words as tokens, characters as latency."""
    c = table(spark, sf, "conversations")
    words = F.size(F.split("text", " "))
    return c.select(
        F.col("role").alias("model"),
        F.length("text").cast("double").alias("latency_ms"),
        F.when(F.col("role") == "assistant", 0).otherwise(words).alias("prompt_tokens"),
        F.when(F.col("role") == "assistant", words).otherwise(0).alias("completion_tokens"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, 0) + make_dt_interval(cast(turn as int), 0, 0, 0)").alias(
            "timestamp"
        ),
    )


@query(
    "a12_latency_by_model",
    """SELECT role AS model, round(avg(length(text)) + 1e-9, 6) AS avg_latency_ms,
              max(length(text))::DOUBLE AS max_latency_ms, count(*) AS total_requests
       FROM conversations GROUP BY 1""",
)
def _(spark, sf):
    out = metrics.latency_by_model(calls(spark, sf), "2024-01-01", hours=24)
    return averaged(out, avg_latency_ms=6)


@query(
    "a12_stage_latency",
    """SELECT round(avg(l_quantity) + 1e-9, 6) AS avg_total_latency_ms, round(avg(l_discount) + 1e-9, 6) AS avg_embedding_ms,
              round(avg(l_tax) + 1e-9, 6) AS avg_search_ms, round(avg(l_extendedprice) + 1e-9, 4) AS avg_llm_ms
       FROM lineitem WHERE l_shipdate > TIMESTAMP '2001-08-01' - INTERVAL 87600 HOUR""",
)
def _(spark, sf):
    stages = {
        "avg_total_latency_ms": "l_quantity", "avg_embedding_ms": "l_discount",
        "avg_search_ms": "l_tax", "avg_llm_ms": "l_extendedprice",
    }
    out = metrics.stage_latency(table(spark, sf, "lineitem"), "2001-08-01", stages, hours=87600, ts="l_shipdate")
    return averaged(out, avg_total_latency_ms=6, avg_embedding_ms=6, avg_search_ms=6, avg_llm_ms=4)


@query(
    "a14_worker_usage",
    """SELECT ts::DATE AS date, event_type AS worker_name, count(*) AS requests,
              round(sum(value), 2) AS total_cpu_time_ms, round(avg(value) + 1e-9, 6) AS avg_latency_ms
       FROM events GROUP BY 1, 2""",
)
def _(spark, sf):
    out = metrics.usage_by_worker(table(spark, sf, "events"), "event_type", "value", "value", ts="ts")
    return averaged(rounded(out, total_cpu_time_ms=2), avg_latency_ms=6)


@query(
    "a15_category_totals",
    """SELECT event_type, count(*) AS records, round(sum(value), 2) AS total,
              event_type IS NULL AS is_total, round(avg(value) + 1e-9, 6) AS average
       FROM events GROUP BY GROUPING SETS ((event_type), ())""",
)
def _(spark, sf):
    out = metrics.category_totals(table(spark, sf, "events"), "event_type", "value")
    return averaged(rounded(out, total=2), average=6)


@query(
    "a19_post_counts",
    "SELECT user_id, count(*) AS post_count FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def _(spark, sf):
    return metrics.top_counts(table(spark, sf, "events"), "user_id")


@query(
    "a20_daily_report",
    """SELECT DATE '2024-01-30' AS report_date, count(*) AS total_events,
              count(DISTINCT user_id) AS unique_users, round(avg(value) + 1e-9, 6) AS avg_session_duration
       FROM events WHERE ts >= TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31'""",
)
def _(spark, sf):
    out = metrics.daily_report(table(spark, sf, "events"), AS_OF, "ts", "user_id", F.col("value"))
    return averaged(out, avg_session_duration=6)


@query(
    "a21_recent_totals",
    """SELECT ts::DATE AS event_date, count(*) AS total_events FROM events
       WHERE ts >= TIMESTAMP '2024-01-24' GROUP BY 1""",
)
def _(spark, sf):
    return metrics.recent_totals(metrics.daily_events(table(spark, sf, "events"), "ts"), AS_OF)


# ------------------------------------------------------- sort, limit, set operations

@query("t1_order_by", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return o.orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@query(
    "t2_top_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("t4_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def _(spark, sf):
    return staging.dedup_rows(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"])


@query(
    "t5_append_all",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return merge.append_all([c, s])


# ------------------------------------------------------- merging and history

def order_updates(spark, sf):
    """New versions of orders from their lines: later date, recomputed price."""
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("updated_at"), F.count("*").cast("double").alias("amount")
    )
    return lines.select("o_orderkey", "updated_at", "amount")


def order_state(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("updated_at"), F.col("o_totalprice").alias("amount")
    )


_VERSIONS = """
    SELECT o_orderkey, o_orderdate AS updated_at, o_totalprice AS amount, 0 AS side FROM orders
    UNION ALL
    SELECT l_orderkey, max(l_shipdate), count(*)::DOUBLE, 1 FROM lineitem GROUP BY l_orderkey"""


@query(
    "l3_merge_by_key",
    f"""SELECT o_orderkey, updated_at, amount FROM ({_VERSIONS})
        QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY updated_at DESC, side DESC) = 1""",
)
def _(spark, sf):
    return merge.merge_by_key(
        order_state(spark, sf), order_updates(spark, sf), ["o_orderkey"], "updated_at"
    )


@query(
    "l4_incremental_filter",
    "SELECT * FROM lineitem WHERE l_shipdate > (SELECT max(o_orderdate) FROM orders)",
)
def _(spark, sf):
    done = table(spark, sf, "orders").withColumnRenamed("o_orderdate", "l_shipdate")
    return merge.incremental_filter(table(spark, sf, "lineitem"), done, "l_shipdate")


@query(
    "l7_evolve_schema",
    """SELECT n_nationkey AS nation_id, n_name, n_regionkey, NULL::VARCHAR AS note FROM nation
       UNION ALL SELECT s_suppkey::INTEGER, s_name, NULL, 'supplier' FROM supplier""",
)
def _(spark, sf):
    old = merge.evolve_schema(
        table(spark, sf, "nation"), add={"note": "string"}, rename={"n_nationkey": "nation_id"}
    )
    new = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("nation_id"), F.col("s_name").alias("n_name"),
        F.lit("supplier").alias("note"),
    )
    return merge.union_evolved(old, new)


@query(
    "l14_scd2_snapshot",
    f"""WITH v AS (SELECT o_orderkey, updated_at, amount FROM ({_VERSIONS})
                   QUALIFY row_number() OVER (PARTITION BY o_orderkey, updated_at ORDER BY side DESC) = 1)
        SELECT o_orderkey, updated_at, amount, updated_at AS valid_from,
               lead(updated_at) OVER w AS valid_to, lead(updated_at) OVER w IS NULL AS is_current
        FROM v WINDOW w AS (PARTITION BY o_orderkey ORDER BY updated_at)""",
)
def _(spark, sf):
    return merge.scd2_snapshot(
        order_state(spark, sf), order_updates(spark, sf), "o_orderkey", "updated_at"
    )


@query(
    "l15_outbox_candidates",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderstatus <> 'P' AND o_orderdate < TIMESTAMP '2001-08-01' - INTERVAL 1 HOUR
       ORDER BY o_orderdate, o_orderkey LIMIT 1000""",
)
def _(spark, sf):
    leads = table(spark, sf, "orders").withColumn("sync", F.col("o_orderstatus") != "P")
    out = merge.outbox_candidates(
        leads, "sync", "o_orderdate", "2001-08-01", order_by=["o_orderdate", "o_orderkey"]
    )
    return out.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "w6_latest_per_key",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return ordered.latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "w7_order_violations",
    """WITH s AS (SELECT value, lag(value) OVER (ORDER BY ts, value) AS before FROM events WHERE value IS NOT NULL)
       SELECT count(*) AS element_count, count(*) FILTER (WHERE value < before) AS unexpected_count FROM s""",
)
def _(spark, sf):
    return ordered.order_violations(table(spark, sf, "events"), "value", "ts")


@query(
    "w7_order_violations_strict",
    """WITH s AS (SELECT l_quantity AS v, lag(l_quantity) OVER (ORDER BY l_shipdate, l_quantity) AS before
                  FROM lineitem WHERE l_quantity IS NOT NULL)
       SELECT count(*) AS element_count, count(*) FILTER (WHERE v <= before) AS unexpected_count FROM s""",
)
def _(spark, sf):
    return ordered.order_violations(table(spark, sf, "lineitem"), "l_quantity", "l_shipdate", strictly=True)


@query(
    "w7_neighbor",
    """SELECT event_id, user_id, ts, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_value
       FROM events""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    day = F.to_date("ts")
    return ordered.neighbor(e, ["user_id"], day, ["ts", "event_id"], "value", "previous_value").drop("value")
