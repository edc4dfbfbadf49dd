"""Round trips through the sources: what is read back is compared with the table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.bindings.base import BILLING_AS_OF, INGESTED_AT, query, raw_posts, table
from lakeops.session import scratch_dir
from lakeops.sources import maintenance, readers, versioned, writers

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query("s4_read_upload_csv", "SELECT * FROM events")
def _(spark, sf):
    path = scratch_dir(spark, "upload")
    micros = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    table(spark, sf, "events").write.options(header=True, **micros).csv(path)
    return readers.read_upload(spark, path, "csv", _EVENTS)


_CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


@query("s2_read_raw_json", "SELECT conv_id, turn, role, text FROM conversations")
def _(spark, sf):
    """Lists of many rows and, for every fiftieth conversation, objects of one."""
    base, talks = scratch_dir(spark, "landed"), table(spark, sf, "conversations")
    alone = F.concat(F.lit("turn-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    name = F.when(F.col("conv_id") % 50 == 0, alone).otherwise(F.concat(F.lit("list-"), (F.col("conv_id") % 50).cast("string")))
    writers.write_json_files(talks, base, name, lone_objects=True).collect()
    return readers.read_raw_json(spark, base, _CONVERSATIONS)


@query("s2_read_raw_json_lines", "SELECT conv_id, turn, role, text FROM conversations")
def _(spark, sf):
    path = scratch_dir(spark, "landed")
    table(spark, sf, "conversations").write.json(path)
    return readers.read_raw_json(spark, path, _CONVERSATIONS, multi_line=False)


def _billing_files(spark, sf, since):
    """Line items from a date on as daily billing files; their folder."""
    base, lines = scratch_dir(spark, "billing"), table(spark, sf, "lineitem").filter(F.col("l_shipdate") >= since)
    rows = lines.select(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_returnflag").alias("service"), F.col("l_suppkey").cast("string").alias("resource"),
        F.col("l_linestatus").alias("metric"), F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("unit_cost"),
        F.col("l_extendedprice").alias("total_cost"), F.lit("USD").alias("currency"))
    writers.write_json_files(rows, base, F.col("date")).collect()
    return base


_BILLING_ROWS = """SELECT l_shipdate::DATE AS date, l_returnflag AS service, l_suppkey::VARCHAR AS resource, l_linestatus AS metric,
       l_quantity AS quantity, l_discount AS unit_cost, l_extendedprice AS total_cost, 'USD' AS currency, l_shipdate::DATE AS file_date
FROM lineitem"""


@query("s3_read_billing", f"{_BILLING_ROWS} WHERE year(l_shipdate) = 1996")
def _(spark, sf):
    return readers.read_billing(spark, _billing_files(spark, sf, "1900-01-01"), prefix="1996-")


@query("s3_read_billing_days", f"{_BILLING_ROWS} WHERE l_shipdate >= TIMESTAMP '1996-11-15' AND l_shipdate < TIMESTAMP '1997-02-16'")
def _(spark, sf):
    return readers.read_billing(spark, _billing_files(spark, sf, "1900-01-01"), start="1996-11-15", end="1997-02-15")


@query("l11_retention_billing", f"{_BILLING_ROWS} WHERE l_shipdate >= TIMESTAMP '{BILLING_AS_OF}' - INTERVAL 90 DAY")
def _(spark, sf):
    base = _billing_files(spark, sf, "1900-01-01")
    maintenance.expire_files(spark, base, "billing", BILLING_AS_OF)
    return readers.read_billing(spark, base)


_MONTHS = """WITH month AS (SELECT date_trunc('month', l_shipdate) AS m, max(l_shipdate) AS newest FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_shipdate, CASE WHEN newest < TIMESTAMP '{0}' - INTERVAL 365 DAY THEN 'archive' ELSE 'curated' END AS layer
FROM lineitem JOIN month ON m = date_trunc('month', l_shipdate)""".format(BILLING_AS_OF)


@query("l11_retention_curated", _MONTHS)
def _(spark, sf):
    """One file per month, none of them in a date directory."""
    path, archive = scratch_dir(spark, "curated"), scratch_dir(spark, "archive")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    month = F.date_format("l_shipdate", "yyyyMM")
    lines.withColumn("part", month).repartition("part").write.partitionBy("part").parquet(path)
    maintenance.expire_files(spark, path, "curated", BILLING_AS_OF, "l_shipdate", archive)
    left, gone = (spark.read.parquet(p).select(*lines.columns, F.lit(layer).alias("layer")) for p, layer in ((path, "curated"), (archive, "archive")))
    return left.unionByName(gone)


@query(
    "l1_add_ingest_metadata",
    f"""SELECT o_orderkey, o_totalprice, 'load-1' AS _dlt_load_id, TIMESTAMP '{INGESTED_AT}' AS ingestion_timestamp,
               64 AS id_length FROM orders""",
)
def _(spark, sf):
    out = writers.add_ingest_metadata(table(spark, sf, "orders"), "load-1", INGESTED_AT)
    return out.select(
        "o_orderkey", "o_totalprice", "_dlt_load_id",
        F.col("ingestion_timestamp").cast("timestamp_ntz").alias("ingestion_timestamp"),
        F.length("_dlt_id").alias("id_length"),
    )


@query("l2_write_raw", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22'")
def _(spark, sf):
    base = scratch_dir(spark, "raw")
    events = table(spark, sf, "events")
    writers.write_raw(events, base, "events", mode="replace", ts="ts")
    out = readers.read_layer(spark, base, "events", start="2024-01-08", end="2024-01-21")
    return out.select(*events.columns)


@query("l13_idempotent_write", "SELECT * FROM orders")
def _(spark, sf):
    path = scratch_dir(spark, "processed")
    orders = table(spark, sf, "orders")
    for _ in range(2):  # the second run replaces the first
        writers.idempotent_write(orders, path, "o_orderstatus")
    return spark.read.parquet(path).select(*orders.columns)


def _post_columns(spark, sf):
    posts = raw_posts(spark, sf).withColumnRenamed("ingestion_timestamp", "seen_at")
    loaded = writers.add_ingest_metadata(posts, "load-1", INGESTED_AT)
    return loaded.withColumn("ingestion_timestamp", F.col("seen_at").cast("timestamp"))


_CURATED = """SELECT user_id::INTEGER AS "userId", event_id::INTEGER AS id, event_type AS title, props AS body,
                     ts AS ingestion_timestamp FROM events"""


def _shown(df):
    ts = F.col("ingestion_timestamp").cast("timestamp_ntz").alias("ingestion_timestamp")
    return df.select("userId", "id", "title", "body", ts)


@query("l5_l6_curated_append", f"{_CURATED} UNION ALL {_CURATED}")
def _(spark, sf):
    path, schema = scratch_dir(spark, "curated"), writers.curated_schema("posts")
    for moment in ("2024-02-01", "2024-02-02"):
        versioned.write_curated(_post_columns(spark, sf), path, schema, moment, "append")
    return _shown(versioned.read_curated(spark, path))


@query("s5_time_travel", _CURATED)
def _(spark, sf):
    path, schema = scratch_dir(spark, "curated"), writers.curated_schema("posts")
    versioned.write_curated(_post_columns(spark, sf), path, schema, "2024-02-01", "overwrite")
    errors = _post_columns(spark, sf).filter(F.col("title") == "error")
    versioned.write_curated(errors, path, schema, "2024-02-02", "overwrite")
    return _shown(versioned.read_curated(spark, path, as_of="2024-02-01 12:00:00"))


@query("l10_l8_compact", f"{_CURATED} UNION ALL {_CURATED}")
def _(spark, sf):
    path, schema = scratch_dir(spark, "curated"), writers.curated_schema("posts")
    for moment in ("2024-02-01", "2024-02-02"):
        versioned.write_curated(_post_columns(spark, sf), path, schema, moment, "append")
    versioned.compact(spark, path, "2024-02-03", partition_by=("_day", "title"))
    return _shown(versioned.read_curated(spark, path))


@query(
    "l5_null_violations",
    """SELECT 'userId' AS "column", count(*) FILTER (WHERE user_id IS NULL) AS violations FROM events
       UNION ALL SELECT 'id', count(*) FILTER (WHERE event_id IS NULL) FROM events
       UNION ALL SELECT 'title', count(*) FILTER (WHERE event_type = 'error') FROM events
       UNION ALL SELECT 'body', count(*) FILTER (WHERE props IS NULL) FROM events""",
)
def _(spark, sf):
    posts = raw_posts(spark, sf).withColumn("title", F.when(F.col("title") != "error", F.col("title")))
    return writers.null_violations(posts, writers.curated_schema("posts"))


@query(
    "l11_retention_label",
    f"""SELECT l_orderkey, l_linenumber, l_shipdate,
               CASE WHEN l_shipdate < TIMESTAMP '{BILLING_AS_OF}' - INTERVAL 365 DAY THEN 'archive' ELSE 'keep' END AS retention_action
        FROM lineitem""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return maintenance.retention_label(lines, "l_shipdate", BILLING_AS_OF, maintenance.RETENTION["curated"])


@query("l11_apply_retention", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-16'")
def _(spark, sf):
    base = scratch_dir(spark, "processed")
    path = writers.write_raw(table(spark, sf, "events"), base, "events", ts="ts", layer="processed")
    maintenance.apply_retention(spark, path, "processed", "2024-02-15")
    return spark.read.parquet(path).select("event_id", "ts")


@query("l12_archive_codec", "SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-16'")
def _(spark, sf):
    base = scratch_dir(spark, "raw")
    path = writers.write_raw(table(spark, sf, "events"), base, "events", ts="ts")
    maintenance.apply_retention(spark, path, "raw", "2024-04-15", f"{base}/archive")
    return spark.read.parquet(f"{base}/archive").select("event_id", "ts")


@query("l2_conform", "SELECT n_nationkey::BIGINT AS id, n_name AS name, NULL::VARCHAR AS note FROM nation")
def _(spark, sf):
    schema = StructType.fromDDL("id bigint NOT NULL, name string, note string")
    nation = table(spark, sf, "nation").withColumnsRenamed({"n_nationkey": "id", "n_name": "name"})
    return writers.conform(nation, schema)


@query("l1_distinct_ids", "SELECT 2 * count(*) AS rows, 2 * count(DISTINCT o_orderkey) AS ids, 2 * count(DISTINCT o_orderkey) AS repeated_ids FROM orders")
def _(spark, sf):
    """Different rows and different loads have different ids; a repeated load has the same."""
    orders = table(spark, sf, "orders")
    loads = [writers.add_ingest_metadata(orders.repartition(n), load, INGESTED_AT) for n, load in ((3, "load-1"), (5, "load-2"))]
    again = [writers.add_ingest_metadata(orders, load, INGESTED_AT) for load in ("load-1", "load-2")]
    ids = lambda frames: frames[0].unionByName(frames[1]).select("_dlt_id")
    seen = ids(loads).agg(F.count("*").alias("rows"), F.countDistinct("_dlt_id").alias("ids"))
    same = ids(loads).distinct().join(ids(again).distinct(), "_dlt_id").agg(F.count("*").alias("repeated_ids"))
    return seen.withColumn("_one", F.lit(1)).join(same.withColumn("_one", F.lit(1)), "_one").drop("_one")


@query("l12_archive_footers", "SELECT 'ZSTD' AS codec, count(*) AS rows FROM events WHERE ts < TIMESTAMP '2024-01-16'")
def _(spark, sf):
    base = scratch_dir(spark, "raw")
    path = writers.write_raw(table(spark, sf, "events"), base, "events", ts="ts")
    maintenance.apply_retention(spark, path, "raw", "2024-04-15", f"{base}/archive")
    return readers.parquet_codecs(spark.read.parquet(f"{base}/archive")).groupBy("codec").agg(F.sum("rows").alias("rows"))
