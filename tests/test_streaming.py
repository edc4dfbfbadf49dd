import datetime as dt
import json
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators import metrics, staging
from lakeops.streaming import cdc, events as ev

T0 = dt.datetime(2024, 1, 1)
DDL = "event_id int, timestamp timestamp_ntz, user_id int, action string"


def land(spark, path, data, ddl=DDL):
    spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(path)


def clicks(n, seed, hours=12):
    rng = random.Random(seed)
    return [
        (rng.randrange(10**6), T0 + dt.timedelta(seconds=rng.randrange(hours * 3600)), rng.choice([1, 1, 1, 2, 3, None]),
         rng.choice(["purchase", "view", "add_to_cart", None]))
        for _ in range(n)
    ]


def test_etl_equals_batch_and_is_idempotent(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))

    def run():
        stream = ev.stream_etl(ev.read_stream(spark, src, DDL, max_files_per_trigger=1))
        ev.run_to_table(stream, out, state).awaitTermination()
        return spark.read.parquet(out)

    land(spark, src, clicks(50, 1))
    land(spark, src, clicks(50, 2))
    assert rows(run()) == rows(staging.categorize_events(spark.read.parquet(src)))
    assert rows(run()) == rows(staging.categorize_events(spark.read.parquet(src)))  # nothing twice
    land(spark, src, clicks(20, 3))
    assert rows(run()) == rows(staging.categorize_events(spark.read.parquet(src)))


def test_dedup_within_watermark(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    land(spark, src, [(1, T0, 1, "v"), (1, T0 + dt.timedelta(minutes=5), 1, "v"), (2, T0, 1, "v")])
    stream = ev.dedup_stream(ev.read_stream(spark, src, DDL), ["event_id"], "timestamp", "1 hour")
    ev.run_to_table(stream, out, state).awaitTermination()
    land(spark, src, [(2, T0 + dt.timedelta(minutes=10), 1, "v"), (3, T0, 1, "v")])
    ev.run_to_table(stream, out, state).awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_hourly_counts_equal_batch_for_closed_hours(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    data = sorted((c for c in clicks(400, 4) if c[2] and c[3]), key=lambda r: r[1])
    for i in range(0, len(data), 100):  # files in event-time order
        land(spark, src, data[i : i + 100])
    stream = ev.hourly_counts_stream(ev.stream_etl(ev.read_stream(spark, src, DDL)))
    ev.run_to_table(stream, out, state).awaitTermination()
    closed = data[-1][1] - dt.timedelta(minutes=10)
    batch = metrics.hourly_categories(staging.categorize_events(spark.read.parquet(src)), "2024-01-02", hours=48)
    want = batch.filter(F.col("hour") + F.expr("INTERVAL 1 HOUR") <= F.lit(str(closed)).cast("timestamp_ntz"))
    got = spark.read.parquet(out).withColumn("hour", F.col("hour").cast("timestamp_ntz"))
    assert rows(got) == rows(want) and got.count() > 20


def test_late_rows_are_dropped(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    late = (9, T0, 9, "view")

    def run():
        stream = ev.hourly_counts_stream(ev.stream_etl(ev.read_stream(spark, src, DDL)))
        ev.run_to_table(stream, out, state).awaitTermination()

    land(spark, src, [(1, T0, 1, "view"), (2, T0 + dt.timedelta(hours=5), 1, "view")])
    run()
    land(spark, src, [late, (3, T0 + dt.timedelta(hours=9), 1, "view")])
    run()
    got = {r["hour"].hour: r["event_count"] for r in spark.read.parquet(out).collect()}
    assert got == {0: 1, 5: 1}


def test_sessions_stream(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    minutes = [0, 10, 45, 300]
    land(spark, src, [(i, T0 + dt.timedelta(minutes=m), 1, "v") for i, m in enumerate(minutes)])
    stream = ev.session_stream(ev.read_stream(spark, src, DDL), ["user_id"], "timestamp")
    ev.run_to_table(stream, out, state).awaitTermination()
    got = [(r["session_start"].minute, r["event_count"]) for r in spark.read.parquet(out).orderBy("session_start").collect()]
    assert got == [(0, 2), (45, 1)]  # the last session is still open


def test_enrich_passes_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "p")], "id int, properties string")
    assert ev.enrich_stream(df).columns == ["id", "properties", "processed_at"]
    assert ev.enrich_stream(df, "2024-01-01").first()["processed_at"] == T0


def test_dead_letters(spark, tmp_path):
    src = str(tmp_path / "src")
    texts = ['{"a": 1, "b": "x"}', '{"a": "no number"}', "{broken", "", '{"b": "y"}', None]
    land(spark, src, [(i, t) for i, t in enumerate(texts)], "offset int, value string")
    good, bad = ev.split_bad_records(spark.read.parquet(src), "a int, b string")
    assert rows(good.drop("extra")) == [(0, 1, "x"), (4, None, "y")]
    assert sorted(r["offset"] for r in bad.collect()) == [1, 2, 3, 5]
    path, state = (str(tmp_path / n) for n in ("records", "state"))
    raw = ev.read_stream(spark, src, "offset int, value string")
    ev.run_with_dead_letters(raw, "a int, b string", path, state).awaitTermination()
    stored = spark.read.parquet(path)
    assert stored.filter("rejected = 'false'").count() == 2
    assert {r["record"] for r in stored.filter("rejected = 'true'").collect()} == {texts[1], texts[2], "", None}


def test_records_keep_unknown_fields(spark):
    texts = ['{"a": 1, "b": "x", "c": {"d": [1, 2]}, "e": null}', '[{"a": 1}]', "7", '{"a": null}', '{"a": 1.5}', '{"a": 9e99}']
    got = ev.typed_records(spark.createDataFrame([(t,) for t in texts], "value string"), "a int, b string").collect()
    assert [(r.a, r.b, r.rejected) for r in got[:4]] == [(1, "x", False), (None, None, True), (None, None, True), (None, None, False)]
    assert json.loads(got[0].extra) == {"c": {"d": [1, 2]}, "e": None} and got[3].extra is None
    assert got[1].record == texts[1] and got[0].record is None and got[5].rejected


def test_dead_letters_parse_once(spark, tmp_path):
    src = str(tmp_path / "src")
    land(spark, src, [('{"a": 1}',)], "value string")
    plan = ev.typed_records(spark.read.parquet(src), "a int, b string")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


@pytest.mark.parametrize("limit", [{"max_files_per_trigger": 2}, {"max_files_per_trigger": None, "max_bytes_per_trigger": 1}])
def test_micro_batches(spark, tmp_path, limit):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    for i in range(5):
        land(spark, src, clicks(10 + i, i))
    query = ev.micro_batches(ev.read_stream(spark, src, DDL, **limit), out, state)
    query.awaitTermination()
    got = [tuple(r) for r in ev.batch_totals(spark, out, DDL).orderBy("batch_id").collect()]
    assert got == ([(0, 21, 21), (1, 25, 46), (2, 14, 60)] if limit["max_files_per_trigger"] else [(i, 10 + i, sum(range(10, 11 + i))) for i in range(5)])
    progress = {r.batch_id: r.input_rows for r in ev.batch_progress(query, spark).collect()}
    assert {b: n for b, n in progress.items() if n} == {b: n for b, n, _ in got}
    assert rows(spark.read.parquet(out).drop("batch_id")) == rows(spark.read.parquet(src))
    land(spark, src, clicks(3, 9))
    ev.micro_batches(ev.read_stream(spark, src, DDL, **limit), out, state).awaitTermination()
    last = ev.batch_totals(spark, out, DDL).orderBy(F.desc("batch_id")).first()
    assert (last["rows"], last["running_total"]) == (3, 63)


# ------------------------------------------------------------------ change data

ROW = "id int, v string"
CDC = f"operation string, table string, before struct<id:int,v:string>, after struct<id:int,v:string>, timestamp timestamp, pos int"


def change(op, id_, v, second, pos=0):
    row = (id_, v)
    return (op, "t", row if op in "ud" else None, row if op != "d" else None, T0 + dt.timedelta(seconds=second), pos)


def fold(target, changes):
    state = dict(target)
    for op, _, before, after, _, _ in sorted(changes, key=lambda c: (c[4], c[5])):
        if op == "d":
            state.pop(before[0], None)
        else:
            state[after[0]] = after[1]
    return sorted(state.items())


CHANGES = [
    change("u", 1, "late", 9), change("c", 1, "first", 1), change("d", 2, "x", 5), change("u", 2, "y", 3),
    change("d", 77, "unknown", 1), change("r", 3, "snap", 1), change("d", 4, "a", 2, 0), change("c", 4, "again", 2, 1),
]


def test_apply_cdc_equals_event_fold(spark):
    target = [(1, "old"), (2, "old"), (5, "same")]
    rng = random.Random(2)
    many = [change(rng.choice("cud"), rng.randrange(6), str(i), rng.randrange(50), i) for i in range(300)]
    many += [change(rng.choice("cud"), 1, f"hot{i}", 60 + i, i) for i in range(200)]  # one hot key
    for changes in (CHANGES, many):
        got = cdc.apply_cdc(spark.createDataFrame(target, ROW), spark.createDataFrame(changes, CDC), "id", ("timestamp", "pos"))
        assert rows(got) == fold(target, changes)


def test_unknown_operations_fail_and_moved_keys_are_deleted(spark):
    target = spark.createDataFrame([(1, "a"), (3, "c")], ROW)
    moved = spark.createDataFrame([change("u", 2, "b", 1)], CDC).withColumn("before", F.expr("named_struct('id', 1, 'v', 'a')").cast(StructType.fromDDL(ROW)))
    assert rows(cdc.apply_cdc(target, moved, "id")) == [(2, "b"), (3, "c")]
    with pytest.raises(Exception, match="unknown operation t"):
        cdc.apply_cdc(target, spark.createDataFrame([change("t", 1, "x", 1)], CDC), "id").collect()


def test_stream_cdc_out_of_order_and_replayed(spark, tmp_path):
    src, state = (str(tmp_path / n) for n in ("src", "state"))
    os.makedirs(src)
    stream = ev.read_stream(spark, src, CDC, max_files_per_trigger=1)

    def run():
        cdc.stream_cdc(stream, state, "id", ("timestamp", "pos")).awaitTermination()
        return rows(cdc.read_current(spark, state))

    ordered = sorted(CHANGES, key=lambda c: (c[4], c[5]))
    land(spark, src, ordered[4:], CDC)  # the later events arrive first
    assert run() == fold([], ordered[4:])
    land(spark, src, ordered[:4], CDC)
    assert run() == fold([], CHANGES)
    assert run() == fold([], CHANGES)
    # the last batch once more, as after a failure between its state and its commit
    last = max(int(n) for n in os.listdir(f"{state}/commits") if n.isdigit())
    for n in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{state}/commits/{n}"):
            os.remove(f"{state}/commits/{n}")
    assert run() == fold([], CHANGES)
    land(spark, src, [change("c", 2, "older than its delete", 4)], CDC)
    land(spark, src, [change("c", 8, "new", 100)], CDC)
    assert run() == fold([], [*CHANGES, change("c", 8, "new", 100)])
    assert rows(cdc.read_current(spark, state, batch_id=0)) == fold([], ordered[4:])


def test_stream_cdc_equals_batch_fold(spark, tmp_path):
    src, state = (str(tmp_path / n) for n in ("src", "state"))
    rng = random.Random(7)
    many = [change(rng.choice("cud"), rng.randrange(40), str(i), rng.randrange(50), i) for i in range(600)]
    rng.shuffle(many)
    for i in range(0, 600, 200):
        land(spark, src, many[i: i + 200], CDC)
    cdc.stream_cdc(ev.read_stream(spark, src, CDC, max_files_per_trigger=1), state, "id", ("timestamp", "pos")).awaitTermination()
    assert rows(cdc.read_current(spark, state)) == fold([], many)


def test_cdc_archive_layout(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    land(spark, src, CHANGES, CDC)
    cdc.cdc_archive(ev.read_stream(spark, src, CDC), out, state).awaitTermination()
    assert os.path.isdir(f"{out}/table=t/date=2024-01-01")
    assert spark.read.parquet(out).count() == len(CHANGES)
