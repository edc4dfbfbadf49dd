import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.plans import pipelines
from lakeops.sources import maintenance, readers, versioned, writers

POST = "userId int, id int, title string, body string"


def frame(spark, days, title="t"):
    data = [(1, i, f"{title}{i}", "b", dt.datetime(2024, 1, d)) for i, d in enumerate(days)]
    return spark.createDataFrame(data, POST + ", ingestion_timestamp timestamp")


def test_raw_json_list_and_object(spark, tmp_path):
    (tmp_path / "list.json").write_text(json.dumps([{"id": 1}, {"id": 2, "userId": 5}], indent=2))
    (tmp_path / "one.json").write_text(json.dumps({"id": 3}))
    got = readers.read_raw_json(spark, str(tmp_path), POST)
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 3]


def test_billing_prefix(spark, tmp_path):
    for day in ("2024-12-31", "2025-01-01", "2025-01-02"):
        (tmp_path / f"{day}.json").write_text(json.dumps([{"date": day, "service": "s", "total_cost": 1.5}], indent=2))
    assert readers.read_billing(spark, str(tmp_path)).count() == 3
    got = readers.read_billing(spark, str(tmp_path), "2025-")
    assert sorted(r["date"] for r in got.collect()) == [dt.date(2025, 1, 1), dt.date(2025, 1, 2)]


def test_upload_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, s string")
    for fmt in ("csv", "json", "parquet"):
        path = str(tmp_path / fmt)
        df.write.format(fmt).options(header=True).save(path)
        assert rows(readers.read_upload(spark, path, fmt, "id int, s string")) == rows(df)
    with pytest.raises(ValueError):
        readers.read_upload(spark, "x", "xlsx", "id int")


def test_sampling_and_inventory(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    assert readers.sample_rows(df, 7).count() == 7 and readers.head(df).count() == 10
    row = readers.file_inventory(df, "raw", 10).first()
    assert row["object_count"] == 4 and row["total_bytes"] == readers.input_bytes(df) and row["over_threshold"]


def test_raw_layer_modes_and_pruning(spark, tmp_path):
    base = str(tmp_path)
    path = writers.write_raw(frame(spark, [1, 2, 3]), base, "posts")
    writers.write_raw(frame(spark, [3, 4]), base, "posts")
    assert readers.read_layer(spark, base, "posts").count() == 5
    writers.write_raw(frame(spark, [3], "new"), base, "posts", mode="replace_dates")
    assert readers.read_layer(spark, base, "posts").count() == 4
    assert os.path.isdir(f"{path}/year=2024/month=01/day=03")
    part = readers.read_layer(spark, base, "posts", start="2024-01-02", end="2024-01-03")
    assert part.count() == 2 and len(part.inputFiles()) >= 2
    scan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(make_date" in scan or "PartitionFilters: [isnotnull" in scan
    with pytest.raises(ValueError):
        writers.write_raw(frame(spark, [1]), base, "posts", mode="upsert")


def test_idempotent_write(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    for _ in range(2):
        writers.idempotent_write(df, path, "k")
    writers.idempotent_write(spark.createDataFrame([(9, "b")], "v int, k string"), path, "k")
    assert sorted((r["v"], r["k"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_ingest_ids_are_stable(spark):
    df = frame(spark, [1, 2]).drop("ingestion_timestamp")
    a = writers.add_ingest_metadata(df, "L", "2024-01-01")
    b = writers.add_ingest_metadata(df.repartition(3), "L", "2024-01-01")
    assert rows(a) == rows(b) and a.select("_dlt_id").distinct().count() == 2


def test_conform(spark):
    schema = StructType.fromDDL("id int NOT NULL, name string, extra double")
    ok = spark.createDataFrame([(1, "a")], "id long, name string")
    assert tuple(writers.conform(ok, schema).first()) == (1, "a", None)
    bad = spark.createDataFrame([(None, "a")], "id long, name string")
    with pytest.raises(Exception, match="NULL in required column id"):
        writers.conform(bad, schema).collect()
    with pytest.raises(ValueError):
        writers.conform(ok.drop("id"), schema)
    assert rows(writers.null_violations(bad, schema)) == [("id", 1)]


# ------------------------------------------------------------------ versions

@pytest.fixture
def posts(spark, tmp_path):
    path, schema = str(tmp_path / "curated"), writers.curated_schema("posts")

    def commit(moment, days, mode="append", title="t"):
        versioned.write_curated(frame(spark, days, title), path, schema, moment, mode)

    return path, commit


def ids(df):
    return sorted(r["title"] for r in df.collect())


def test_versions_and_time_travel(spark, posts):
    path, commit = posts
    commit("2024-02-01", [1, 2], title="a")
    commit("2024-02-02", [2, 3], title="b")
    commit("2024-02-03", [5], "overwrite", title="c")
    commit("2024-02-04", [6], title="d")
    assert ids(versioned.read_curated(spark, path)) == ["c0", "d0"]
    assert ids(versioned.read_curated(spark, path, "2024-02-02")) == ["a0", "a1", "b0", "b1"]
    assert ids(versioned.read_curated(spark, path, "2024-02-01 23:00:00")) == ["a0", "a1"]
    assert ids(versioned.read_curated(spark, path, days=("2024-01-06", "2024-01-31"))) == ["d0"]
    with pytest.raises(ValueError):
        versioned.read_curated(spark, path, "2024-01-01")
    with pytest.raises(ValueError):
        commit("2024-02-02", [1])
    assert [r["is_current"] for r in versioned.list_snapshots(spark, path).orderBy("snapshot_ts").collect()] == [
        False, False, True, True,
    ]


def test_repeated_commit_loads_once(spark, posts):
    path, commit = posts
    commit("2024-02-01", [1, 2])
    commit("2024-02-01", [1, 2])
    assert versioned.read_curated(spark, path).count() == 2


def test_unfinished_commit_is_invisible(spark, posts):
    path, commit = posts
    commit("2024-02-01", [1], title="a")
    commit("2024-02-02", [2], title="b")
    os.remove(f"{path}/commit=20240202T000000000000-append-_day/_SUCCESS")
    assert ids(versioned.read_curated(spark, path)) == ["a0"]


def test_expire_keeps_what_readers_need(spark, posts):
    path, commit = posts
    commit("2024-01-01", [1], "overwrite", title="a")
    commit("2024-01-02", [1], title="b")
    commit("2024-01-03", [1], "overwrite", title="c")
    commit("2024-03-01", [1], title="d")
    gone = versioned.expire_snapshots(spark, path, "2024-03-10")
    assert gone == [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)]
    assert ids(versioned.read_curated(spark, path)) == ["c0", "d0"]
    assert versioned.expire_snapshots(spark, path, "2034-03-10") == []


def test_compaction_and_new_partitioning(spark, posts):
    path, commit = posts
    for d in range(1, 6):
        commit(f"2024-02-0{d}", [1, 2], title=str(d))
    schema = writers.curated_schema("posts")
    regrouped = frame(spark, [4], title="r")
    versioned.write_curated(regrouped, path, schema, "2024-02-06", partition_by=("_day", "userId"))
    assert versioned.read_curated(spark, path, days=("2024-01-04", "2024-01-04")).count() == 1
    assert versioned.read_curated(spark, path, schema=schema).count() == 11
    before = ids(versioned.read_curated(spark, path))
    assert versioned.compact(spark, path, "2024-02-09", partition_by=("_day", "userId")) > 0
    after = versioned.read_curated(spark, path)
    assert ids(after) == before and len(after.inputFiles()) == 3
    commit("2024-02-10", [3], title="z")
    assert ids(versioned.read_curated(spark, path)) == sorted([*before, "z0"])
    assert versioned.commits(spark, path)[-1].layout == ("_day", "userId")  # new data follows the layout


def test_schema_grows_across_commits(spark, tmp_path):
    path = str(tmp_path / "t")
    old = StructType.fromDDL("id int, ingestion_timestamp timestamp")
    new = StructType.fromDDL("id int, ingestion_timestamp timestamp, note string")
    versioned.write_curated(frame(spark, [1]), path, old, "2024-01-01")
    versioned.write_curated(frame(spark, [2]).withColumn("note", F.lit("n")), path, new, "2024-01-02")
    got = versioned.read_curated(spark, path)
    assert sorted((r["note"] or "") for r in got.collect()) == ["", "n"]


# ------------------------------------------------------------------ retention

def test_retention(spark, tmp_path):
    base, archive = str(tmp_path / "raw"), str(tmp_path / "archive")
    path = writers.write_raw(frame(spark, [1, 2, 3, 4]), base, "posts")
    # 90 days after 2024-01-03: the 1st and 2nd are older
    assert maintenance.apply_retention(spark, path, "raw", "2024-04-02", archive) == ["2024-01-01", "2024-01-02"]
    assert spark.read.parquet(path).count() == 2 and spark.read.parquet(archive).count() == 2
    assert os.path.isdir(f"{archive}/year=2024/month=01/day=02")
    assert maintenance.apply_retention(spark, path, "raw", "2024-04-02", archive) == []
    with pytest.raises(ValueError):
        maintenance.apply_retention(spark, path, "raw", "2024-05-02")
    assert maintenance.apply_retention(spark, path, "processed", "2024-05-02") == ["2024-01-03", "2024-01-04"]


def test_late_rows_join_the_archive(spark, tmp_path):
    base, archive = str(tmp_path / "raw"), str(tmp_path / "archive")
    path = writers.write_raw(frame(spark, [1, 1, 1, 2, 3]), base, "posts")
    maintenance.apply_retention(spark, path, "raw", "2024-04-02", archive)
    writers.write_raw(frame(spark, [1], "late"), base, "posts")
    maintenance.apply_retention(spark, path, "raw", "2024-04-02", archive)
    assert spark.read.parquet(archive).count() == 5
    assert spark.read.parquet(archive).filter("title like 'late%'").count() == 1


def test_interrupted_archive_is_repeated(spark, tmp_path, monkeypatch):
    base, archive = str(tmp_path / "raw"), str(tmp_path / "archive")
    path = writers.write_raw(frame(spark, [1, 2, 2]), base, "posts")
    monkeypatch.setattr(maintenance.paths, "delete_dir", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        maintenance.apply_retention(spark, path, "raw", "2024-04-02", archive)
    monkeypatch.undo()
    assert maintenance.apply_retention(spark, path, "raw", "2024-04-02", archive) == ["2024-01-01", "2024-01-02"]
    assert spark.read.parquet(archive).count() == 3


def test_replace_whole_table_or_dates(spark, tmp_path):
    base = str(tmp_path)
    for mode, left in (("replace", 1), ("replace_dates", 2)):
        path = writers.write_raw(frame(spark, [1, 2]), base, mode)
        writers.write_raw(frame(spark, [2], "new"), base, mode, mode=mode)
        assert spark.read.parquet(path).count() == left


def test_retention_split_keeps_undated_rows(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01' ts UNION ALL SELECT NULL UNION ALL SELECT timestamp_ntz'2024-03-01'")
    kept, expired = maintenance.retention_split(df, "ts", "2024-03-02", maintenance.RETENTION["processed"])
    assert (kept.count(), expired.count()) == (2, 1)
    labels = maintenance.retention_label(df, "ts", "2024-03-02", maintenance.RETENTION["processed"])
    assert labels.filter("retention_action = 'delete'").count() == 1


# ------------------------------------------------------------------ end to end

def test_ingest_to_mart(spark, tmp_path):
    base, landed = str(tmp_path / "raw"), tmp_path / "landed"
    landed.mkdir()
    posts = [{"userId": 1, "id": i, "title": "t", "body": "b" * i} for i in range(1, 4)]
    (landed / "posts.json").write_text(json.dumps(posts))
    users = [{"id": i, "name": f"N{i}", "username": f"u{i}", "email": f"u{i}@x.com", "address": {"city": "c"}} for i in (1, 2)]
    (landed / "users.json").write_text(json.dumps(users))
    record = pipelines.ingest_json(spark, f"{landed}/posts.json", POST, base, "posts", "L1", "2024-01-01").first()
    assert (record["rows_written"], record["status"], record["outputs"]) == (3, "COMPLETE", [f"{base}/posts"])
    ddl = "id int, name string, username string, email string, phone string, website string, address struct<city:string>"
    pipelines.ingest_json(spark, f"{landed}/users.json", ddl, base, "users", "L1", "2024-01-01")
    raw_posts, raw_users = readers.read_layer(spark, base, "posts"), readers.read_layer(spark, base, "users")
    mart = pipelines.build_user_posts(raw_users, raw_posts, "2024-01-02")
    got = {r["user_id"]: (r["total_posts"], r["avg_post_length"], r["max_post_length"]) for r in mart.collect()}
    assert got == {1: (3, 2.0, 3), 2: (0, None, None)}
    checks = pipelines.daily_checkpoint(spark, raw_users, raw_posts, "2024-01-02")
    assert [(r["dataset"], r["expectation"], r["column"]) for r in checks.filter("NOT success").collect()] == []
    curated = str(tmp_path / "curated")
    pipelines.promote_to_curated(raw_posts, curated, "posts", "2024-01-02")
    assert versioned.read_curated(spark, curated).columns == [f.name for f in writers.curated_schema("posts")]


def landed(spark, tmp_path, days, **options):
    from lakeops.sources import writers

    data = [(d, "svc", str(i), "m", 1.0 * i, 0.5, 0.5 * i, "USD") for d in days for i in range(3)]
    df = spark.createDataFrame(data, readers.BILLING_SCHEMA.replace("date date", "date string"))
    base = str(tmp_path / "billing")
    report = writers.write_json_files(df, base, F.col("date"), **options).collect()
    return df, base, report


DAYS = ["2024-12-31", "2025-01-01", "2025-01-02", "2025-02-03"]


def test_billing_files_are_pruned_by_name(spark, tmp_path):
    df, base, report = landed(spark, tmp_path, DAYS)
    assert sorted(tuple(r) for r in report) == [(f"{d}.json", 3) for d in DAYS]
    year = readers.read_billing(spark, base, prefix="2025-")
    assert sorted(f.rpartition("/")[2] for f in year.inputFiles()) == [f"{d}.json" for d in DAYS[1:]]  # all that is listed
    assert year.count() == 9 and {str(r.file_date) for r in year.collect()} == set(DAYS[1:])
    days = readers.read_billing(spark, base, start="2025-01-01", end="2025-01-02")
    assert {str(r.date) for r in days.collect()} == {"2025-01-01", "2025-01-02"} and days.count() == 6
    scan = days._jdf.queryExecution().executedPlan().toString()
    assert "file_name" in scan and days.rdd.getNumPartitions() <= 2  # two files are opened
    os.utime(f"{base}/{DAYS[0]}.json", (1, 1))
    assert readers.read_billing(spark, base, modified_after="2001-01-01").count() == 9
    with open(f"{base}/notes.json", "w") as out:
        out.write("{}")
    assert readers.read_billing(spark, base).filter("file_date IS NULL").count() == 1


def test_json_files_split_hot_names_and_keep_lone_objects(spark, tmp_path):
    _, base, report = landed(spark, tmp_path, DAYS, rows_per_file=2)
    assert sum(r["rows"] for r in report) == 12 and len(report) > 4
    assert readers.read_billing(spark, base, prefix="2025-01-01").count() == 3
    from lakeops.sources import writers

    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "n string, v int")
    writers.write_json_files(df, str(tmp_path / "x"), F.col("n"), lone_objects=True).collect()
    assert open(tmp_path / "x" / "a.json").read() == '{"n":"a","v":1}\n'
    assert sorted(os.listdir(tmp_path / "x")) == ["a.json", "b.json"]
    assert sorted(r.v for r in readers.read_raw_json(spark, str(tmp_path / "x"), "n string, v int").collect()) == [1, 2, 3]


def test_files_expire_by_name(spark, tmp_path):
    _, base, _ = landed(spark, tmp_path, DAYS)
    with open(f"{base}/undated.json", "w") as out:
        out.write("{}")
    gone = maintenance.expire_files(spark, base, "billing", "2025-04-02")
    assert [g.rpartition("/")[2] for g in gone] == [f"{d}.json" for d in DAYS[:3]][:len(gone)] and len(gone) == 2
    assert sorted(os.listdir(base)) == ["2025-01-02.json", "2025-02-03.json", "undated.json"]
    assert maintenance.expire_files(spark, base, "billing", "2025-04-02") == []


def test_files_expire_by_newest_row(spark, tmp_path):
    path, archive = str(tmp_path / "curated"), str(tmp_path / "archive")
    for day, null in (("2023-01-05", False), ("2023-02-05", True), ("2024-05-05", False)):
        times = [dt.datetime.fromisoformat(day), dt.datetime.fromisoformat("2023-01-01")] + [None] * null
        spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz").coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(ValueError):
        maintenance.expire_files(spark, path, "curated", "2024-06-01", "ts")
    gone = maintenance.expire_files(spark, path, "curated", "2024-06-01", "ts", archive)
    assert len(gone) == 1 and spark.read.parquet(archive).count() == 2
    assert spark.read.parquet(path).count() == 5  # a missing time and a newer row keep their files whole
    assert maintenance.expire_files(spark, path, "curated", "2024-06-01", "ts", archive) == []
