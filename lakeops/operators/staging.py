"""Staging projections and row-level cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from lakeops.functions.casts import lenient_double, lenient_long
from lakeops.functions.timeparts import Moment, instant, since


def stage_posts(raw: DataFrame) -> DataFrame:
    """Typed posts in fixed column order.

    ``loaded_at`` is the ingestion time of the row, not the time of the query:
    freshness and volume monitors on a view would otherwise always see "now".
    """
    return raw.select(
        F.col("id").cast("bigint").alias("post_id"),
        F.col("userId").cast("bigint").alias("user_id"),
        F.col("title").cast("string").alias("title"),
        F.col("body").cast("string").alias("body"),
        F.col("ingestion_timestamp").alias("loaded_at"),
    )


def json_text(df: DataFrame, column: str) -> Column:
    """Nested column as JSON text; text columns pass through, absent ones are NULL."""
    if column not in df.columns:
        return F.lit(None).cast("string")
    if isinstance(df.schema[column].dataType, (StructType, MapType, ArrayType)):
        return F.to_json(F.col(column))
    return F.col(column).cast("string")


def stage_users(raw: DataFrame) -> DataFrame:
    """Typed users; nested address and company become JSON text."""
    return raw.select(
        F.col("id").cast("bigint").alias("user_id"),
        F.col("name").cast("string").alias("user_name"),
        F.col("username").cast("string").alias("username"),
        F.col("email").cast("string").alias("email"),
        F.col("phone").cast("string").alias("phone"),
        F.col("website").cast("string").alias("website"),
        json_text(raw, "address").alias("address_json"),
        json_text(raw, "company").alias("company_json"),
        F.col("ingestion_timestamp").alias("loaded_at"),
    )


def clean_rows(
    df: DataFrame, id_col: str = "id", name_col: str = "name", amount_col: str = "amount"
) -> DataFrame:
    """Drop rows without id or amount, trim the name, fix amounts at DECIMAL(10,2).

    An amount that does not fit is no amount: its row is dropped as well.
    """
    amount = F.col(amount_col).try_cast("decimal(10,2)")
    kept = df.filter(F.col(id_col).isNotNull() & amount.isNotNull())
    return kept.withColumns({name_col: F.trim(F.col(name_col)), amount_col: amount})


def event_category(action: Column) -> Column:
    return (
        F.when(action == "purchase", "conversion")
        .when(action == "add_to_cart", "engagement")
        .otherwise("other")
    )


def categorize_events(df: DataFrame, action: str = "action", user: str = "user_id") -> DataFrame:
    """Drop events without action or user and add ``event_category``. Works on streams."""
    kept = df.filter(F.col(action).isNotNull() & F.col(user).isNotNull())
    return kept.withColumn("event_category", event_category(F.col(action)))


def parse_records(df: DataFrame, as_of: Moment) -> DataFrame:
    """Text records (id, timestamp, value) to numbers, 0 where a field does not parse."""
    return df.select(
        lenient_long(F.col("id")).alias("id"),
        lenient_long(F.col("timestamp")).alias("timestamp"),
        lenient_double(F.col("value")).alias("value"),
        instant(as_of).alias("processed_at"),
    )


def time_range(df: DataFrame, ts: str, as_of: Moment, **window: float) -> DataFrame:
    """Rows of the last ``days=`` / ``hours=`` before ``as_of``."""
    return df.filter(since(df, ts, as_of, **window))


def dedup_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """SELECT DISTINCT over the named columns (default all)."""
    return (df.select(*columns) if columns else df).distinct()
