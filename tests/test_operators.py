import datetime as dt
import random
import time

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.operators import joins, merge, metrics, ordered, staging
from lakeops.plans import marts

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


# ------------------------------------------------------------------ staging

def test_stage_users_nested_and_missing(spark):
    raw = spark.sql(
        "SELECT 1 id, 'n' name, 'u' username, 'e' email, 'p' phone, 'w' website, "
        "named_struct('city', 'x', 'geo', named_struct('lat', 1)) address, timestamp'2024-01-01' ingestion_timestamp"
    )
    out = staging.stage_users(raw)
    assert out.columns[-3:] == ["address_json", "company_json", "loaded_at"]
    row = out.first()
    assert row["address_json"] == '{"city":"x","geo":{"lat":1}}' and row["company_json"] is None


def test_clean_rows(spark):
    df = spark.createDataFrame(
        [(1, " a ", 1.005), (None, "b", 1.0), (2, "c", None), (3, None, 1e12)], "id long, name string, amount double"
    )
    got = rows(staging.clean_rows(df))
    assert [(r[0], r[1]) for r in got] == [(1, "a")]  # an amount that does not fit is no amount


def test_categorize_events(spark):
    df = spark.createDataFrame(
        [("purchase", 1), ("add_to_cart", 1), ("view", 1), (None, 1), ("view", None)], "action string, user_id int"
    )
    assert [r[2] for r in staging.categorize_events(df).collect()] == ["conversion", "engagement", "other"]


# ------------------------------------------------------------------ joins

def test_referential_integrity_and_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    assert tuple(joins.referential_integrity(child, parent, "k", "id").first()) == (5, 2, False)
    assert joins.orphans(child, parent, "k", "id").count() == 2


def test_tokens_expire(spark):
    vault = spark.createDataFrame([("t1", "a", at(10)), ("t2", "b", at(-10))], "token string, value string, expires_at timestamp_ntz")
    df = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "tok string")
    assert rows(joins.resolve_tokens(df, vault, "tok", T0)) == [("t1", "a"), ("t2", None), ("t3", None)]


# ------------------------------------------------------------------ merging

def test_merge_by_key(spark):
    target = spark.createDataFrame([(1, 1, "old"), (2, 5, "keep"), (3, 1, "only")], "k int, v int, s string")
    updates = spark.createDataFrame([(1, 2, "new"), (2, 4, "late"), (1, 1, "tie"), (4, 0, "ins")], "k int, v int, s string")
    assert rows(merge.merge_by_key(target, updates, ["k"], "v")) == [
        (1, 2, "new"), (2, 5, "keep"), (3, 1, "only"), (4, 0, "ins"),
    ]
    tie = spark.createDataFrame([(2, 5, "update")], "k int, v int, s string")
    assert (2, 5, "update") in rows(merge.merge_by_key(target, tie, ["k"], "v"))


def test_merge_with_maps_in_payload(spark):
    a = spark.sql("SELECT 1 k, 1 v, map('a', 1) m")
    b = spark.sql("SELECT 1 k, 2 v, map('b', 2) m")
    assert merge.merge_by_key(a, b, ["k"], "v").first()["m"] == {"b": 2}


def test_incremental_twice_equals_full_once(spark):
    src = spark.createDataFrame([(i, at(i)) for i in range(10)], "id int, ts timestamp_ntz")
    first = src.filter("id < 6")
    step = merge.incremental_filter(src, first, "ts")
    assert rows(first.unionByName(step)) == rows(src)
    assert merge.incremental_filter(src, src, "ts").count() == 0
    assert rows(merge.incremental_filter(src, first.limit(0), "ts")) == rows(src)
    assert rows(merge.incremental_filter(src, None, "ts")) == rows(src)


def test_incremental_filter_keeps_microseconds(spark):
    mark = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.123456' ts")
    src = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.123456' ts UNION ALL SELECT timestamp_ntz'2024-01-01 00:00:00.123457'")
    assert merge.incremental_filter(src, mark, "ts").count() == 1


def test_incremental_filter_in_another_time_zone(spark, monkeypatch):
    src = spark.range(24).selectExpr("id", "timestamp_seconds(1704067200 + id * 3600) AS ts")
    monkeypatch.setenv("TZ", "Asia/Tokyo")
    time.tzset()
    try:
        assert merge.incremental_filter(src, src.filter("id < 12"), "ts").count() == 12
    finally:
        monkeypatch.undo()
        time.tzset()


def test_evolve_schema(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    out = merge.evolve_schema(df, add={"c": "double"}, rename={"b": "d"})
    assert out.dtypes == [("a", "int"), ("d", "string"), ("c", "double")]
    with pytest.raises(ValueError):
        merge.evolve_schema(df, add={"a": "int"})


def test_scd2(spark):
    ddl = "k int, u timestamp_ntz, v string"
    first = merge.scd2_snapshot(
        spark.createDataFrame([], ddl), spark.createDataFrame([(1, at(0), "a"), (2, at(1), "x")], ddl), "k", "u"
    )
    second = merge.scd2_snapshot(first, spark.createDataFrame([(1, at(90_000), "b"), (2, at(1), "y")], ddl), "k", "u")
    got = {(r["k"], r["v"]): (r["valid_from"], r["valid_to"], r["is_current"]) for r in second.collect()}
    assert got == {
        (1, "a"): (at(0), at(90_000), False),
        (1, "b"): (at(90_000), None, True),
        (2, "y"): (at(1), None, True),
    }


def test_outbox(spark):
    ddl = "id int, flag boolean, synced timestamp_ntz"
    df = spark.createDataFrame(
        [(1, True, at(0)), (2, True, at(1)), (3, False, at(0)), (4, True, at(-600)), (5, None, at(-600))], ddl
    )
    due = merge.outbox_candidates(df, "flag", "synced", at(60), ["id"])
    assert [r["id"] for r in due.collect()] == [4]  # exactly one hour ago is not yet due
    due = merge.outbox_candidates(df, "flag", "synced", at(62), ["id"])
    assert [r["id"] for r in due.collect()] == [1, 2, 4]
    results = spark.createDataFrame([(1, None), (2, "timeout")], "id int, error string")
    ledger = merge.sync_ledger_rows(results, "id", at(62))
    again = merge.outbox_candidates(df, "flag", "synced", at(63), ["id"], ledger, "id")
    assert [r["id"] for r in again.collect()] == [2, 4]


# ------------------------------------------------------------------ ordered

def brute_lag(data):
    out, last = {}, {}
    for k, t, i, v in sorted(data, key=lambda r: (str(r[0]), r[1], r[2])):
        out[i] = last.get(k)
        last[k] = v
    return out


@pytest.mark.parametrize("previous", [True, False])
def test_neighbor_against_brute_force(spark, previous):
    rng = random.Random(3)
    # one key holds most rows, values may be NULL, keys may be NULL
    data = [
        (rng.choice([1, 1, 1, 1, 2, None]), at(rng.randrange(0, 6000)), i, rng.choice([None, i])) for i in range(500)
    ]
    df = spark.createDataFrame(data, "k int, t timestamp_ntz, i int, v int")
    got = ordered.neighbor(df, ["k"], F.to_date("t"), ["t", "i"], "v", "n", previous)
    if previous:
        want = brute_lag(data)
    else:
        flipped = [(k, dt.datetime(2100, 1, 1) - (t - T0), -i, v) for k, t, i, v in data]
        want = {-i: n for i, n in brute_lag(flipped).items()}
    assert {r["i"]: r["n"] for r in got.collect()} == want
    assert got.columns == ["k", "t", "i", "v", "n"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(-3, 3))), max_size=30), st.booleans()
)
def test_order_violations_against_brute_force(spark, data, strictly):
    df = spark.createDataFrame(data, "o int, v int")
    kept = sorted((o, v) for o, v in data if v is not None)
    bad = sum((b[1] <= a[1]) if strictly else (b[1] < a[1]) for a, b in zip(kept, kept[1:]))
    got = ordered.order_violations(df, "v", "o", strictly, partitions=3).first()
    assert tuple(got) == (len(kept), bad)


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile(spark, q):
    import numpy as np

    rng = random.Random(5)
    values = [rng.gauss(0, 1) for _ in range(300)] + [0.5] * 400  # one value holds most rows
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert ordered.exact_quantile(df, "v", q) == pytest.approx(np.quantile(values, q))


def test_exact_quantiles_of_many_columns(spark):
    import numpy as np

    rng, n = np.random.default_rng(3), 60_000  # far more than a sketch holds
    data = {"a": rng.normal(size=n), "b": rng.integers(0, 9, n).astype(float), "c": np.where(np.arange(n) % 3 == 0, 7.5, rng.random(n) * 100), "d": np.full(n, 2.0)}
    df = spark.createDataFrame(list(zip(*(x.tolist() for x in data.values()))), "a double, b double, c double, d double")
    df = df.repartition(7).withColumns({"e": F.lit(None).cast("double"), "f": F.when(F.col("b") < 8, F.col("a")).otherwise(float("nan")), "g": F.col("b").cast("decimal(4,1)")})
    wanted = {c: (0.0, 0.001, 0.25, 0.5, 0.8, 0.999, 1.0) for c in "abcdefg"}
    got = ordered.exact_quantiles(df, wanted)
    for c in "abcd":
        for q in wanted[c]:
            assert got[c, q] == pytest.approx(np.quantile(data[c], q)), (c, q)
    assert all(got["e", q] is None for q in wanted["e"]) and all(got["g", q] == got["b", q] for q in wanted["g"])
    numbers = np.sort(data["a"][data["b"] < 8])
    assert got["f", 0.5] == pytest.approx(np.append(numbers, [np.inf] * (n - len(numbers)))[int(0.5 * (n - 1)):][:2].mean())
    assert np.isnan(got["f", 1.0]) and np.isnan(got["f", 0.999])


def test_quantiles_take_three_actions(spark, monkeypatch):
    df, calls = spark.range(5_000).selectExpr("id * 1.0 AS a", "id % 7 AS b", "-id AS c"), []
    kind = type(df)
    for name in ("first", "collect", "count"):
        monkeypatch.setattr(kind, name, lambda self, *x, f=getattr(kind, name), name=name: (calls.append(name), f(self, *x))[1])
    ordered.exact_quantiles(df, {c: (0.1, 0.5, 0.9) for c in "abc"})
    assert calls.count("first") + calls.count("collect") - calls.count("first") <= 3 and calls.count("first") == 2


def test_a_bracket_that_misses_is_replaced(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANK_ERROR", -0.05)
    df = spark.range(40_001).selectExpr("(id * 7919) % 40001 * 1.0 AS v").repartition(3)
    assert ordered.exact_quantile(df, "v", 0.5) == 20_000.0


def test_exact_quantile_of_nothing(spark):
    assert ordered.exact_quantile(spark.createDataFrame([], "v double"), "v") is None


def brute_sessions(events, gap):
    out = []
    for user in sorted({u for u, _ in events}):
        times = sorted(t for u, t in events if u == user)
        start = last = times[0]
        n = 1
        for t in times[1:]:
            if (t - last).total_seconds() <= gap:
                n += 1
            else:
                out.append((user, start, last, n))
                start, n = t, 1
            last = t
        out.append((user, start, last, n))
    return out


def test_sessions_against_brute_force(spark):
    rng = random.Random(11)
    events = [(rng.choice([1, 1, 1, 2, 3]), T0 + dt.timedelta(seconds=rng.randrange(0, 400_000))) for _ in range(600)]
    events += [(4, at(0)), (4, at(30)), (4, at(60)), (4, at(90) + dt.timedelta(microseconds=1))]  # exact gaps
    df = spark.createDataFrame([(u, t, 1.0) for u, t in events], "user_id int, ts timestamp_ntz, value double")
    got = marts.session_aggregated(df).select("user_id", "session_start", "session_end", "event_count")
    assert rows(got) == brute_sessions(events, 1800)


def test_latest_per_key_has_no_window(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (None, 1, "z")], "k int, o int, s string")
    out = ordered.latest_per_key(df, ["k"], ["o"])
    assert rows(out) == [(None, 1, "z"), (1, 2, None)]
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ metrics

def test_run_stats_with_unfinished_run(spark):
    runs = spark.createDataFrame(
        [("f", at(0), at(1), "COMPLETED"), ("f", at(5), None, "RUNNING"), ("f", at(9), at(9), "FAILED")],
        "flow_name string, start_time timestamp_ntz, end_time timestamp_ntz, status string",
    )
    row = metrics.run_stats(runs, "2024-01-02").first()
    assert (row["total_runs"], row["successful"], row["failed"], row["avg_duration_seconds"]) == (3, 1, 1, 30.0)


def test_category_totals_empty_and_null(spark):
    empty = spark.createDataFrame([], "category string, amount double")
    assert rows(metrics.category_totals(empty)) == [(None, 0, None, True, None)]
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 3.0)], "category string, amount double")
    got = {(r["category"], r["is_total"]): (r["records"], r["total"], r["average"]) for r in metrics.category_totals(df).collect()}
    assert got == {("a", False): (2, 1.0, 1.0), (None, False): (1, 3.0, 3.0), (None, True): (3, 4.0, 2.0)}


def test_daily_report_of_an_empty_day(spark):
    df = spark.createDataFrame([(at(0), 1, 2.0)], "ts timestamp_ntz, u int, d double")
    row = metrics.daily_report(df, "2024-01-05 13:00:00", "ts", "u", F.col("d")).first()
    assert tuple(row) == (dt.date(2024, 1, 4), 0, 0, None)


# ------------------------------------------------------------------ marts

def test_user_posts(spark):
    users = spark.createDataFrame(
        [(1, "A", "a", "a@x"), (2, "B", "b", "b@x"), (3, "C", "c", "c@x"), (3, "C", "c", "c@x"), (None, "N", "n", "n@x")],
        "user_id int, user_name string, username string, email string",
    )
    posts = spark.createDataFrame(
        [(1, 1, "aa", at(0)), (2, 1, "bbbb", at(1)), (None, 1, None, at(2)), (3, 3, "c", at(3)), (4, None, "x", at(4))],
        "post_id int, user_id int, body string, loaded_at timestamp_ntz",
    )
    joined = users.join(posts, "user_id", "left").groupBy("user_id", "user_name", "username", "email").agg(
        F.count("post_id"), F.avg(F.length("body")), F.max(F.length("body")), F.min(F.length("body")), F.max("loaded_at")
    )
    out = marts.fct_user_posts(users, posts, T0).drop("calculated_at")
    assert rows(out) == rows(joined)


def test_calendar_fills_gaps(spark):
    df = spark.createDataFrame([(at(0),), (at(60 * 24 * 9),)], "ts timestamp_ntz")
    assert marts.dim_dates(df, "ts").count() == 10
    assert marts.dim_dates(df.limit(0), "ts").count() == 0


def test_user_activity_expands_no_row(spark):
    data = [(u, k, dt.datetime(2024, 1, d, h)) for u, k, d, h in [(1, "a", 1, 1), (1, "a", 1, 2), (1, "b", 2, 1), (1, None, 3, 1), (2, "a", 1, 1)]]
    df = spark.createDataFrame([*data, (3, "a", None)], "user_id int, event_type string, ts timestamp_ntz")
    got = marts.user_activity(df)
    assert {r.user_id: (r.event_count, r.event_types, r.active_days) for r in got.collect()} == {1: (4, 2, 3), 2: (1, 1, 1), 3: (1, 1, 0)}
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_daily_bitmaps_add_up(spark):
    rng = random.Random(6)
    data = [(dt.datetime(2024, rng.choice([1, 2]), rng.randint(1, 28)), rng.choice("ab"), rng.choice([rng.randint(0, 50), 32_767, 32_768, 32_769, 70_000, 2**40])) for _ in range(900)]
    df = spark.createDataFrame([*data, (dt.datetime(2024, 1, 1), "a", None)], "timestamp timestamp_ntz, kind string, user_id bigint").repartition(4)
    days = metrics.daily_bitmaps(df, ["kind"])
    got = {(str(r.month), r.kind): r.unique_users for r in metrics.distinct_users(days, F.trunc("date", "month").alias("month"), "kind").collect()}
    want = {}
    for t, k, u in data:
        want.setdefault((f"2024-{t.month:02}-01", k), set()).add(u)
    assert got == {x: len(u) for x, u in want.items()}
    plan = metrics.distinct_users(days, "kind")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and metrics.distinct_users(days.limit(0), "kind").collect() == []
