"""End-to-end flows: landed files to curated tables, staged tables to checked marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakeops.functions.timeparts import Moment
from lakeops.operators.staging import stage_posts, stage_users
from lakeops.operators.suite import observe_run, run_checkpoint, run_record
from lakeops.plans import suites
from lakeops.plans.marts import fct_user_posts
from lakeops.sources.readers import read_raw_json
from lakeops.sources.versioned import read_curated, write_curated
from lakeops.sources.writers import add_ingest_metadata, curated_schema, write_raw


def ingest_json(
    spark: SparkSession, landed: str | list[str], schema: StructType | str, base: str, table: str,
    load_id: str, ingested_at: Moment, mode: str = "append",
) -> DataFrame:
    """Landed JSON -> raw layer with load metadata; returns the run record.

    Rows are counted while they are written, not in a second pass.
    """
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = add_ingest_metadata(read_raw_json(spark, landed, schema), load_id, ingested_at)
    counted, seen = observe_run(rows, f"ingest_{table}_{load_id}")
    path = write_raw(counted, base, table, mode)
    written = seen.get["rows"]
    ended = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    inputs = [landed] if isinstance(landed, str) else landed
    return run_record(
        spark, load_id, f"ingest_{table}", "COMPLETE", started, ended, written, written, inputs, [path]
    )


def promote_to_curated(
    raw: DataFrame, path: str, table: str, committed_at: Moment, mode: str = "append"
) -> None:
    """Raw rows -> curated table in its declared schema, partitioned by ingestion day."""
    write_curated(raw, path, curated_schema(table), committed_at, mode)


def build_user_posts(raw_users: DataFrame, raw_posts: DataFrame, calculated_at: Moment) -> DataFrame:
    """Staging and mart in one plan; Catalyst sees it whole."""
    return fct_user_posts(stage_users(raw_users), stage_posts(raw_posts), calculated_at)


def daily_checkpoint(
    spark: SparkSession, raw_users: DataFrame, raw_posts: DataFrame, run_at: Moment,
    history_path: str | None = None,
) -> DataFrame:
    """Validate the staged models (not the raw layer, whose columns differ)."""
    return run_checkpoint(
        spark,
        [
            ("api_posts", stage_posts(raw_posts), suites.POSTS_SUITE),
            ("api_users", stage_users(raw_users), suites.USERS_SUITE),
        ],
        run_at,
        history_path,
    )


__all__ = [
    "build_user_posts", "daily_checkpoint", "ingest_json", "promote_to_curated", "read_curated",
]
