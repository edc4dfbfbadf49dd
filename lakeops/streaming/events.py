"""Event streams: stateless ETL, de-duplication, hourly counts, sessions.

Every function takes and returns an unbounded DataFrame; ``run_to_table`` attaches
the file sink. The same functions accept a batch frame where no watermark is used.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakeops.functions.timeparts import Moment, instant
from lakeops.operators.staging import categorize_events
from lakeops.sources.writers import balanced


def read_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
    max_files_per_trigger: int | None = 1000, glob: str | None = None, max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """File source with a declared schema. ``max_files_per_trigger`` or, instead of it,
    ``max_bytes_per_trigger`` bounds a batch; files enter in order of their time."""
    reader = spark.readStream.schema(schema)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    elif max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.format(fmt).load(path)


def run_to_table(
    stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = (),
    processing_time: str | None = None, codec: str = "zstd",
) -> StreamingQuery:
    """Append a stream to Parquet, exactly once per checkpoint.

    Without ``processing_time`` the query takes what is there in micro-batches
    and stops (``availableNow``); with it, it runs until stopped. Partitioned
    output is gathered by partition value first; AQE, which also covers stateless
    streams, splits a hot value and merges small ones.
    """
    if partition_by:
        stream = balanced(stream, *partition_by)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("compression", codec)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stream_etl(events: DataFrame, action: str = "action", user: str = "user_id") -> DataFrame:
    """Drop incomplete events and add ``event_category``."""
    return categorize_events(events, action, user)


def enrich_stream(events: DataFrame, processed_at: Moment | None = None) -> DataFrame:
    """Add ``processed_at``; all other columns pass through.

    Without a fixed moment it is the time of the micro-batch, one value per batch.
    """
    at = F.current_timestamp() if processed_at is None else instant(processed_at).cast("timestamp")
    return events.withColumn("processed_at", at)


def as_event_time(events: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP, not TIMESTAMP_NTZ."""
    return events.withColumn(ts, F.col(ts).cast("timestamp"))


def dedup_stream(events: DataFrame, keys: list[str], ts: str, delay: str = "24 hours") -> DataFrame:
    """First event per key; repetitions up to ``delay`` later are dropped.

    State is bounded by the watermark.
    """
    return as_event_time(events, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def hourly_counts_stream(
    events: DataFrame, ts: str = "timestamp", category: str = "event_category", user: str = "user_id",
    delay: str = "10 minutes",
) -> DataFrame:
    """Events and exact distinct users per hour and category, emitted once an hour
    is past the watermark; later rows are dropped.

    Two chained aggregates: per user first, then over users. The first spreads a
    hot category over its users and keeps the distinct count exact.
    """
    per_user = (
        as_event_time(events, ts)
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 hour"), F.col(category).alias("event_category"), F.col(user).alias("_user"))
        .agg(F.count("*").alias("_n"))
    )
    hour = F.window(F.window_time("window"), "1 hour")
    return (
        per_user.groupBy(hour.alias("hour"), "event_category")
        .agg(F.sum("_n").alias("event_count"), F.count("_user").alias("unique_users"))
        .select(F.col("hour.start").alias("hour"), "event_category", "event_count", "unique_users")
    )


def session_stream(
    events: DataFrame, keys: list[str], ts: str, gap: str = "30 minutes 1 microsecond", delay: str = "1 hour"
) -> DataFrame:
    """Gap sessions per key, emitted once closed by the watermark. As in batch, events
    exactly 30 minutes apart share a session; a window ends where its gap begins, so
    the gap is one microsecond longer."""
    return (
        as_event_time(events, ts)
        .withWatermark(ts, delay)
        .groupBy(*keys, F.session_window(ts, gap).alias("_session"))
        .agg(F.count("*").alias("event_count"), F.max(ts).alias("session_end"))
        .select(*keys, F.col("_session.start").alias("session_start"), "session_end", "event_count")
    )


def micro_batches(stream: DataFrame, path: str, checkpoint: str, codec: str = "zstd") -> StreamingQuery:
    """Write what a stream admits per batch (see ``read_stream``) to ``path/batch_id=<n>``.

    A batch that is run again after a failure replaces its own directory, so rows are
    written exactly once and the batch that brought a row stays known.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.option("compression", codec).parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def batch_progress(query: StreamingQuery, spark: SparkSession) -> DataFrame:
    """``batch_id``, ``input_rows`` and ``duration_ms`` of the batches that the query's progress
    still holds (``spark.sql.streaming.numRecentProgressUpdates`` of them)."""
    found = {p.batchId: (p.batchId, p.numInputRows, p.batchDuration) for p in query.recentProgress}
    return spark.createDataFrame(sorted(found.values()), "batch_id bigint, input_rows bigint, duration_ms bigint")


def batch_totals(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One row per written batch: ``batch_id``, ``rows`` and ``running_total``."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    written = spark.read.schema(StructType([*fields.fields]).add("batch_id", "long")).parquet(path)
    counts = written.groupBy("batch_id").agg(F.count("*").alias("rows"))  # a row per batch, no more
    return counts.withColumn("running_total", F.sum("rows").over(Window.orderBy("batch_id")))


def typed_records(raw: DataFrame, schema: StructType | str, text: str = "value", extra: str = "extra") -> DataFrame:
    """JSON text rows, parsed once: the fields of ``schema``, ``extra`` (JSON of the fields that
    it lacks), ``record`` and ``rejected``.

    The text becomes a VARIANT, from which fields are cast. A row is rejected, and keeps
    its text as ``record`` for a replay, if the text is blank or no JSON object, or if a
    field has a value that is none of its type; its fields are then null.
    """
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    others = [c for c in raw.columns if c != text]
    members = F.try_variant_get("_variant", "$", "map<string, variant>")
    parsed = raw.withColumn("_variant", F.try_parse_json(F.col(text))).withColumn("_members", members)
    path = {f.name: "$['" + f.name.replace("'", "\\'") + "']" for f in fields}
    typed = {f.name: F.try_variant_get("_variant", path[f.name], f.dataType.simpleString()) for f in fields}
    value = {f.name: F.try_variant_get("_variant", path[f.name], "variant") for f in fields}
    wrong = [value[f.name].isNotNull() & ~F.is_variant_null(value[f.name]) & typed[f.name].isNull() for f in fields]
    bad = F.lit(False) if not wrong else functools.reduce(operator.or_, wrong)
    rows = parsed.withColumn("_bad", F.col("_members").isNull() | bad)
    good = ~F.col("_bad")
    unknown = F.map_filter("_members", lambda k, _: ~k.isin([f.name for f in fields]))
    return rows.select(
        *others, *(F.when(good, typed[f.name]).alias(f.name) for f in fields),
        F.when(good & (F.size(unknown) > 0), F.to_json(unknown)).alias(extra),
        F.when(~good, F.col(text)).alias("record"), F.col("_bad").alias("rejected"))


def split_bad_records(raw: DataFrame, schema: StructType | str, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(parsed, rejected)`` of ``typed_records``."""
    rows = typed_records(raw, schema, text)
    others = [c for c in raw.columns if c != text]
    return rows.filter("NOT rejected").drop("record", "rejected"), rows.filter("rejected").select(*others, "record")


def run_with_dead_letters(raw: DataFrame, schema: StructType | str, path: str, checkpoint: str, text: str = "value") -> StreamingQuery:
    """One exactly-once query that reads and parses the source once and writes good and
    rejected rows beside each other, to ``path/rejected=false`` and ``path/rejected=true``."""
    return run_to_table(typed_records(raw, schema, text), path, checkpoint, partition_by=("rejected",))
