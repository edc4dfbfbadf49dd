import datetime as dt
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeops.operators import anomaly, checks, profile, suite
from lakeops.operators.checks import Expectation as E, Suite
from lakeops.plans import suites


def run(df, *expectations):
    out = suite.run_suite(df, Suite("s", expectations)).collect()
    return {r["position"]: r for r in out}


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "a@x.com", 10.0), (2, "bad", 20.0), (2, None, 40.0), (None, "", None)], "id int, email string, v double"
    )


def test_map_checks_skip_null_except_not_null(people):
    got = run(
        people,
        E("not_null", "email"),
        E("matches_regex", "email", {"regex": checks.EMAIL_REGEX}),
        E("not_empty_string", "email"),
        E("values_between", "v", {"low": 10, "high": 40}),
        E("in_set", "id", {"values": [1, 2]}),
        E("matches_regex", "email", {"regex": checks.EMAIL_REGEX}, mostly=0.3),
    )
    counts = {i: (r["success"], r["element_count"], r["unexpected_count"]) for i, r in got.items()}
    assert counts == {
        0: (False, 4, 1), 1: (False, 3, 2), 2: (False, 3, 1), 3: (True, 3, 0), 4: (True, 3, 0), 5: (True, 3, 2),
    }
    assert got[1]["unexpected_percent"] == pytest.approx(200 / 3)


def test_aggregates_unique_and_order(people):
    got = run(
        people,
        E("row_count_between", kwargs={"low": 1, "high": 3}),
        E("mean_between", "v", {"low": 23, "high": 24}),
        E("stdev_between", "v", {"high": 1}),
        E("median_between", "v", {"low": 20, "high": 20}),
        E("unique", "id"),
        E("increasing", "v", {"order_by": "id"}),
        E("increasing", "id", {"order_by": "v"}),
    )
    assert [got[i]["success"] for i in range(7)] == [False, True, False, True, False, True, True]
    assert got[4]["unexpected_count"] == 2 and got[4]["element_count"] == 3
    assert got[3]["observed"] == "20.0"


def test_schema_checks(people):
    got = run(
        people,
        E("columns_match_ordered_list", kwargs={"columns": ["id", "email", "v"]}),
        E("columns_match_ordered_list", kwargs={"columns": ["email", "id", "v"]}),
        E("columns_match_set", kwargs={"columns": ["v", "email", "id"]}),
        E("column_exists", "nope"),
        E("type_in_list", "id", {"types": ["INTEGER", "BIGINT"]}),
        E("of_type", "email", {"type": "TIMESTAMP"}),
    )
    assert [got[i]["success"] for i in range(6)] == [True, False, True, False, True, False]


def test_empty_table_passes_map_checks_but_not_moments(people):
    got = run(people.limit(0), E("not_null", "id"), E("unique", "id"), E("mean_between", "v", {"low": 0}),
              E("row_count_between", kwargs={"low": 1}))
    assert [got[i]["success"] for i in range(4)] == [True, True, False, False]


def test_map_checks_share_one_aggregate(people):
    out = suite.run_suite(people, Suite("s", [E("not_null", c) for c in people.columns]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_custom_expectation(people):
    checks.register_expectation("even", lambda c: c % 2 == 0)
    assert run(people, E("even", "id"))[0]["unexpected_count"] == 1
    with pytest.raises(ValueError):
        run(people, E("odd", "id"))


def test_suite_from_config(people):
    config = {
        "expectation_suite_name": "x",
        "expectations": [
            {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "id", "mostly": 0.7}},
            {"expectation_type": "expect_column_value_lengths_to_be_between", "kwargs": {"column": "email", "max_value": 7}},
            {"expectation_type": "expect_table_columns_to_match_ordered_list", "kwargs": {"column_list": ["id"]}},
        ],
    }
    out = suite.run_suite(people, checks.suite_from_config(config)).orderBy("position").collect()
    assert [r["success"] for r in out] == [True, True, False]
    assert {r["suite"] for r in out} == {"x"}


def test_dates_and_pii(spark):
    df = spark.createDataFrame([("2024-01-31", "call 555-1234"), ("31/01/2024", "fine"), (None, None)], "d string, t string")
    got = run(df, E("dateutil_parseable", "d"), E("not_contains_pii", "t"),
              E("dateutil_parseable", "d", {"formats": ["yyyy-MM-dd", "dd/MM/yyyy"]}))
    assert [got[i]["unexpected_count"] for i in range(3)] == [1, 1, 0]


def test_failing_rows(people):
    assert rows(checks.failing_rows(people, E("not_null", "email"))) == [(2, None, 40.0)]
    assert checks.failing_rows(people, E("unique", "id")).count() == 2
    assert checks.failing_rows(people, E("values_between", "v", {"high": 15})).count() == 2


def test_checkpoint_history(spark, people, tmp_path):
    path = str(tmp_path / "history")
    s = Suite("s", (E("not_null", "id"), E("unique", "v")))
    for moment in ("2024-01-01", "2024-01-02", "2024-01-02"):  # a repeated run replaces its results
        out = suite.run_checkpoint(spark, [("a", people, s), ("b", people.filter("id = 1"), s)], moment, path)
        assert out.count() == 4
    assert tuple(suite.checkpoint_outcome(out).first()) == (False, 4, 3, 1)
    history = spark.read.parquet(path)
    summary = suite.quality_summary(history).first()
    assert (summary["total_validations"], summary["failed"], summary["datasets"]) == (8, 2, 2)
    assert summary["success_rate"] == 75.0
    assert rows(suite.quality_trend(history))[0] == (dt.date(2024, 1, 1), 3, 1)
    assert rows(suite.failures_by_dataset(history)) == [("a", 2)]


def test_freshness(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01' ts")
    status = lambda d, t: suite.freshness(d, "ts", t).first()["status"]
    assert status(df, "2024-01-02") == "pass"
    assert status(df, "2024-01-02 00:00:01") == "warn"
    assert status(df, "2024-01-03 00:00:01") == "error"
    assert status(df.limit(0), "2024-01-02") == "error"


def test_schema_changes(spark):
    old, new = spark.sql("SELECT 1 a, 'x' b, 1 c"), spark.sql("SELECT 1 a, 2 b, 1 d")
    assert rows(suite.schema_changes(spark, old, new)) == [
        ("b", "Type Changed", "string -> int"), ("c", "Column Removed", "int"), ("d", "Column Added", "int"),
    ]


def test_declared_suites_name_known_checks():
    known = {*checks.MAP_EXPECTATIONS, *checks.AGGREGATE_EXPECTATIONS, *checks.TABLE_EXPECTATIONS, *checks.SHUFFLE_EXPECTATIONS}
    for s in (suites.POSTS_SUITE, suites.USERS_SUITE, suites.USER_POSTS_SUITE):
        assert {e.name for e in s.expectations} <= known
    assert (len(suites.POSTS_SUITE.expectations), len(suites.USERS_SUITE.expectations)) == (12, 11)


# ------------------------------------------------------------------ anomalies

def events(spark, counts, start=dt.date(2024, 1, 1)):
    data = [(dt.datetime.combine(start + dt.timedelta(days=i), dt.time(5)), float(i)) for i, n in enumerate(counts) for _ in range(n)]
    return spark.createDataFrame(data, "ts timestamp_ntz, v double")


def test_volume_anomalies_against_brute_force(spark):
    counts = [10, 12, 0, 11, 10, 60, 11, 0, 10, 11]
    out = {r["date"].day: r for r in anomaly.volume_anomalies(events(spark, counts), "ts", "2024-01-11", days_back=10).collect()}
    assert len(out) == 10
    for i, n in enumerate(counts):
        prior, row = counts[:i], out[i + 1]
        assert row["row_count"] == n
        flag = False
        if len(prior) >= 2 and statistics.stdev(prior) > 0:
            z = (n - statistics.mean(prior)) / statistics.stdev(prior)
            assert row["z_score"] == pytest.approx(z)
            flag = abs(z) > 3
        assert row["is_anomaly"] == flag
    assert out[6]["is_anomaly"] and not out[1]["is_anomaly"]


def test_constant_history_is_not_anomalous(spark):
    out = anomaly.volume_anomalies(events(spark, [5, 5, 5, 500]), "ts", "2024-01-05", days_back=4)
    assert not any(r["is_anomaly"] for r in out.collect())


def test_dimension_anomalies_new_value_and_null(spark):
    df = events(spark, [3, 3, 3]).withColumn("k", F.when(F.col("v") == 2, "new").when(F.col("v") == 1, None).otherwise("old"))
    out = anomaly.dimension_anomalies(df, "ts", ["k"], "2024-01-04", days_back=3)
    got = {(r["k"], r["date"].day): (r["row_count"], r["is_new"]) for r in out.collect()}
    assert len(got) == 9
    assert got[("new", 3)] == (3, True) and got[(None, 2)] == (3, True) and got[("old", 2)] == (0, False)


def test_column_anomalies_skip_empty_days(spark):
    df = events(spark, [2, 2, 0, 2]).withColumn("v", F.when(F.col("v") > 0, F.col("v")))
    out = anomaly.all_columns_anomalies(df, "ts", ["v"], "2024-01-05", days_back=4, metrics=["avg", "null_rate"])
    got = {(r["metric"], r["date"].day): r["value"] for r in out.collect()}
    assert got == {("avg", 2): 1.0, ("avg", 4): 3.0, ("null_rate", 1): 1.0, ("null_rate", 2): 0.0, ("null_rate", 4): 0.0}


# ------------------------------------------------------------------ profiles

def test_profiles_equal_pandas(people):
    import pandas as pd

    doubled = people.unionByName(people.filter("id = 1"))
    pdf = pd.DataFrame([tuple(r) for r in doubled.collect()], columns=doubled.columns)
    q = profile.quality_metrics(doubled).first()
    assert q["duplicate_rows"] == pdf.duplicated().sum() and q["total_rows"] == len(pdf)
    assert q["missing_values"] == pdf.isna().sum().sum() and q["columns_with_missing"] == (pdf.isna().sum() > 0).sum()
    c = profile.column_profile(doubled, "id").first()
    assert (c["count"], c["unique_values"], c["missing"]) == (4, 2, 1)
    d = profile.describe(doubled, ["v"], exact=True).first()
    want = pdf["v"].describe()
    assert [d["mean"], d["std"], d["q25"], d["q50"], d["q75"]] == pytest.approx(
        [want["mean"], want["std"], want["25%"], want["50%"], want["75%"]]
    )
    assert rows(profile.missing_by_column(people)) == [("email", 1), ("id", 1), ("v", 1)]


def test_duplicates_of_zero_nan_and_null(spark):
    df = spark.createDataFrame([(0.0, "a"), (-0.0, "a"), (float("nan"), None), (float("nan"), None), (None, "")], "v double, s string")
    row = profile.quality_metrics(df).first()
    assert (row["duplicate_rows"], row["missing_values"], row["columns_with_missing"]) == (2, 3, 2)
    assert profile.quality_metrics(df.limit(0)).first()["total_rows"] == 0


def test_value_counts_only_for_few_values(spark):
    df = spark.range(100).select((F.col("id") % 49).alias("few"), "id")
    assert profile.value_counts(df, "few").count() == 20
    assert profile.value_counts(df, "id").count() == 0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "v double")
    assert [r["count"] for r in profile.histogram(df, "v", 2).orderBy("bin").collect()] == [1, 2]
    one = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert sum(r["count"] for r in profile.histogram(one, "v", 4).collect()) == 2


def test_ad_hoc_sql(people):
    assert profile.ad_hoc_sql("SELECT count(*) n FROM {t}", t=people).first()["n"] == 4


def test_checks_at_write_time_equal_a_scan(spark, tmp_path):
    data = [(i, None if i % 7 == 0 else f"t{i % 5}", float(i % 11) if i % 13 else None) for i in range(300)]
    df = spark.createDataFrame(data, "id int, title string, v double").repartition(3)
    wanted = Suite("s", (
        E("row_count_between", kwargs={"low": 1, "high": 200}), E("not_null", "title"), E("unique", "id"), E("length_between", "title", {"low": 2, "high": 2}, mostly=0.5),
        E("mean_between", "v", {"low": 4, "high": 6}), E("median_between", "v", {"low": 4, "high": 6}), E("stdev_between", "v", {"low": 0, "high": 1}),
        E("values_between", "v", {"low": 3}), E("of_type", "id", {"type": "INT"})))
    writes, path = [], str(tmp_path / "out")

    def write(frame):
        writes.append(frame)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    got = suite.write_checked(df, wanted, write)
    assert rows(got) == rows(suite.run_suite(df, wanted)) and len(writes) == 1
    assert spark.read.parquet(path).count() == 300
    scans = got.filter("expectation <> 'unique'")._jdf.queryExecution().optimizedPlan().toString()
    assert scans.count("Relation [") <= 2  # uniqueness and the median's count read the table, plain counts don't
    empty = suite.write_checked(df.limit(0), wanted, lambda f: (f.write.parquet(path + "0"), spark.read.schema(f.schema).parquet(path + "0"))[1])
    assert rows(empty) == rows(suite.run_suite(df.limit(0), wanted))
