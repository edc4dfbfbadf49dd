"""Change-data capture: apply, archive and stream change events.

Operations: ``c`` create, ``r`` snapshot read, ``u`` update, ``d`` delete. An
update carries the whole row, so the state of a key is its last event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.ordered import latest_per_key
from lakeops.streaming.events import run_to_table

OPERATIONS = ("c", "r", "u", "d")


def last_change_per_key(
    changes: DataFrame, key: str, order_by: Sequence[str] = ("timestamp",)
) -> DataFrame:
    """``key, operation, after``: the last event of each key.

    Name a log position after the timestamp in ``order_by`` if events of one key
    can share a timestamp; otherwise the event's hash decides, the same on retry.
    """
    last = latest_per_key(keyed_changes(changes, key, order_by), ["_key"], [*order_by, "_tie"])
    return last.select(F.col("_key").alias(key), "operation", "after")


def keyed_changes(changes: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """``_key, operation, after``, the order columns and ``_tie``.

    An update that changes the key is a delete of the old one as well. An operation
    that is none of ``OPERATIONS`` fails the job: a skipped event would be lost.
    """
    new, old = F.col(f"after.{key}"), F.col(f"before.{key}")
    unknown = F.raise_error(F.concat(F.lit("unknown operation "), F.coalesce("operation", F.lit("NULL")))).cast("string")
    operation = F.when(F.col("operation").isin(*OPERATIONS), F.col("operation")).otherwise(unknown)
    own = F.struct(F.coalesce(new, old).alias("_key"), operation.alias("operation"), F.col("after").alias("after"))
    gone = F.struct(old.alias("_key"), F.lit("d").alias("operation"), F.lit(None).cast(changes.schema["after"].dataType).alias("after"))
    moved = F.coalesce((F.col("operation") != "d") & (new != old), F.lit(False))
    events = changes.select(F.explode(F.when(moved, F.array(own, gone)).otherwise(F.array(own))).alias("_e"), *order_by)
    return events.select("_e.*", *order_by).withColumn("_tie", F.xxhash64("operation", F.to_json("after")))


def apply_cdc(
    target: DataFrame, changes: DataFrame, key: str, order_by: Sequence[str] = ("timestamp",)
) -> DataFrame:
    """The target after all changes, in event order per key.

    Changes are folded to one row per key before they meet the target. A delete
    of an unknown key has no effect; an update of one inserts it.
    """
    last = last_change_per_key(changes, key, order_by)
    untouched = target.join(last.select(key), key, "left_anti").select(*target.columns)
    written = last.filter(F.col("operation") != "d").select("after.*").select(*target.columns)
    return untouched.unionByName(written)


def cdc_archive(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append change events to ``table=/date=`` directories."""
    dated = changes.withColumn("date", F.to_date("timestamp"))
    return run_to_table(dated, path, checkpoint, partition_by=("table", "date"))


# ------------------------------------------------------------------ streamed state


def stream_cdc(changes: DataFrame, checkpoint: str, key: str, order_by: Sequence[str] = ("timestamp",)) -> StreamingQuery:
    """Keep the table behind a change stream as keyed state below ``checkpoint``.

    A streaming aggregate holds each key's last event by ``order_by``, whenever it
    arrived: events of a batch are folded before the shuffle, and the state store
    (RocksDB, see ``lakeops.session``) touches only the keys of the batch. Deletes stay
    in the state, so an older event that arrives later is recognised at any delay.
    Replayed batches are settled by the checkpoint; the fold is the same twice.
    """
    last = F.max_by(F.struct("operation", "after"), F.struct(*order_by, "_tie"))
    states = keyed_changes(changes, key, order_by).groupBy("_key").agg(last.alias("last"))
    writer = states.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_current(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Rows of the table that ``stream_cdc`` keeps, as of its last finished batch or an
    earlier one that the state store still holds."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    held = state.schema["value"].dataType.fields[0].name  # the event; its place comes second
    event = F.col("value")[held]
    return state.filter(event["operation"] != "d").select(event["after"].alias("after")).select("after.*")
