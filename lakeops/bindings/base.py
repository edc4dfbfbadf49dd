"""Registry and the frames that several bindings share.

Bindings read whole tables. Where an operator has a time window of its own, the
moment it looks back from is fixed below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

EVENTS_AS_OF = "2024-01-31 00:00:00"
BILLING_AS_OF = "2001-08-01"
INGESTED_AT = "2024-02-01 00:00:00"
KINDS = ("signup", "purchase", "view", "click", "error")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, sf_dir)``; without ``sql`` only rows are checked."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, **decimals: int) -> DataFrame:
    """Round doubles that depend on the order of additions."""
    return df.withColumns({c: F.round(c, n) for c, n in decimals.items()})


def averaged(df: DataFrame, **decimals: int) -> DataFrame:
    """Round means. Half-way cases (a sum of cents over 32 rows) may lie on either
    side by the last bit, so both engines add 1e-9 before they round."""
    return df.withColumns({c: F.round(F.col(c) + 1e-9, n) for c, n in decimals.items()})


# ------------------------------------------------------- users and posts

def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    username = F.lower(F.replace("c_name", F.lit("#"), F.lit("")))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        username.alias("username"),
        F.concat(username, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+81-"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("phone"),
        F.concat(F.lit("www."), F.lower("c_mktsegment"), F.lit(".example.com")).alias("website"),
        F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("address"),
        F.struct(F.col("c_name").alias("name")).alias("company"),
        F.lit(INGESTED_AT).cast("timestamp_ntz").alias("ingestion_timestamp"),
    )


USERS_SQL = f"""
    SELECT c_custkey::BIGINT AS user_id, c_name AS user_name,
           lower(replace(c_name, '#', '')) AS username,
           lower(replace(c_name, '#', '')) || '@example.com' AS email,
           '+81-' || lpad(c_custkey::VARCHAR, 8, '0') AS phone,
           'www.' || lower(c_mktsegment) || '.example.com' AS website,
           '{{"nation":' || c_nationkey || ',"segment":"' || c_mktsegment || '"}}' AS address_json,
           '{{"name":"' || c_name || '"}}' AS company_json,
           TIMESTAMP '{INGESTED_AT}' AS loaded_at
    FROM customer"""


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("userId"),
        F.col("event_id").alias("id"),
        F.col("event_type").alias("title"),
        F.col("props").alias("body"),
        F.col("ts").alias("ingestion_timestamp"),
    )


POSTS_SQL = """
    SELECT event_id::BIGINT AS post_id, user_id::BIGINT AS user_id, event_type AS title,
           props AS body, ts AS loaded_at
    FROM events"""


# ------------------------------------------------------- billing

def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as billing rows: two metrics by line status."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("service"),
        F.col("l_suppkey").cast("string").alias("resource"),
        F.when(F.col("l_linestatus") == "O", "requests").otherwise("cpu_time").alias("metric"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_cost"),
    )


BILLING_SQL = """
    SELECT l_shipdate AS date, l_returnflag AS service, l_suppkey::VARCHAR AS resource,
           CASE WHEN l_linestatus = 'O' THEN 'requests' ELSE 'cpu_time' END AS metric,
           l_quantity AS quantity, l_extendedprice AS total_cost
    FROM lineitem"""
