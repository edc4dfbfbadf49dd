import datetime as dt

import pytest
from conftest import rows

from lakeops.operators import costs

DDL = "date date, service string, resource string, metric string, quantity double, total_cost double"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def billing(spark, data):
    return spark.createDataFrame(data, DDL)


@pytest.mark.parametrize(
    "plan,requests,r2,d1,kv,analytics,minutes,total",
    [
        ("free", 3_000_000, 50, 1, 0.1, 100_000, 0, 0.6),
        ("bundled", 30_000_000, 500, 5, 1.0, 5_000_000, 0, 22.35),
        ("unbound", 300_000_000, 2000, 10, 5.0, 50_000_000, 14_400, 319.3),
    ],
)
def test_monthly_bill_of_known_accounts(spark, plan, requests, r2, d1, kv, analytics, minutes, total):
    usage = spark.createDataFrame(
        [(1, plan, requests, r2, d1, kv, analytics, minutes)],
        "account int, workers_plan string, workers_requests_per_month long, r2_storage_gb int, d1_storage_gb int, "
        "kv_storage_gb double, analytics_engine_writes long, github_actions_minutes int",
    )
    row = costs.tiered_monthly_cost(usage).first()
    assert row["total"] == pytest.approx(total)
    assert row["total"] == pytest.approx(sum(row["breakdown"].asDict().values()))


def test_bill_at_and_over_the_free_tier(spark):
    usage = spark.createDataFrame(
        [("free", 3_000_000, 10), ("free", 3_000_001, 11), ("vip", 1, 1), (None, 0, 0)],
        "workers_plan string, workers_requests_per_month long, r2_storage_gb int",
    )
    got = [r["total"] for r in costs.tiered_monthly_cost(usage).collect()]
    assert got[0] == 0 and got[1] == pytest.approx(0.015 + 0.5e-6)
    assert got[2] is None  # unknown plan
    assert got[3] == 0  # a missing plan is the default one


def test_priced_rows(spark):
    usage = spark.createDataFrame([(day(0), "w", 2_000_000, 3e9)], "date date, worker_name string, requests long, total_cpu_time_ms double")
    bucket = spark.createDataFrame([(day(0), "b", 10**12)], "date date, name string, size_bytes long")
    got = {r["service"]: r["total_cost"] for r in costs.usage_cost(usage, bucket).collect()}
    assert got["Workers"] == pytest.approx(1.0 + 0.06) and got["R2"] == pytest.approx(0.5)


def test_month_to_date_shares_peers_and_truncates(spark):
    df = billing(spark, [(day(0), "s", "r", "m", 1.0, 1.0), (day(40), "s", "r", "m", 1.0, 2.0),
                         (day(40), "s", "q", "m", 1.0, 3.0), (day(33), "s", "r", "m", 1.0, 10.0)])
    got = {(r["date"], r["resource"]): r["month_to_date_cost"] for r in costs.month_to_date(df, day(41), days=5).collect()}
    assert got == {(day(40), "r"): 5.0, (day(40), "q"): 5.0}
    full = costs.month_to_date(df, day(41), days=5, full_history=True)
    assert {r["month_to_date_cost"] for r in full.collect()} == {15.0}


def test_anomalies(spark):
    df = billing(spark, [
        (day(0), "s", "r", "m", 1.0, 10.0), (day(1), "s", "r", "m", 1.0, 8.0), (day(1), "s", "r", "n", 1.0, 8.0),
        (day(2), "s", "r", "m", 1.0, 16.5), (day(1), "s", "zero", "m", 1.0, 0.0), (day(2), "s", "zero", "m", 1.0, 5.0),
    ])
    got = costs.cost_anomalies(df, day(3)).collect()
    assert [(r["date"], r["resource"], r["total_cost"], r["prev_cost"], r["pct_change"]) for r in got] == [
        (day(1), "r", 16.0, 10.0, pytest.approx(60.0))
    ]


def test_forecast_uses_eight_rows_in_date_order(spark):
    df = billing(spark, [(day(i), "s", "r", "m", 1.0, float(i)) for i in reversed(range(10))])
    got = rows(costs.cost_forecast(df, day(10)))
    assert got[0] == (day(11), 0.0) and got[6] == (day(17), 3.0) and len(got) == 7
    wide = rows(costs.cost_forecast(df, day(10), horizon=10))
    assert wide[9] == (day(20), sum(range(2, 10)) / 8)


def test_unit_cost(spark):
    df = billing(spark, [(day(0), "s", "big", "requests", 2000.0, 4.0), (day(0), "s", "small", "requests", 1000.0, 9.0),
                         (day(0), "s", "none", "requests", 0.0, 1.0)])
    assert rows(costs.unit_cost(df, day(1))) == [("big", 2.0)]
    got = dict(rows(costs.unit_cost(df, min_quantity=None, limit=None, scale=1.0)))
    assert got["none"] is None and got["small"] == 0.009


def test_alerts(spark):
    df = billing(spark, [(day(0), "s", "r", "m", 1.0, 1.0), (day(1), "s", "r", "m", 1.0, 4.0)])
    assert tuple(costs.spend_alert(df, day(1)).first()) == (4.0, 2.5, True)
    assert tuple(costs.spend_alert(df, day(9)).first()) == (0.0, 2.5, False)
    assert tuple(costs.projected_spend(df, day(1), 75).first()) == (5.0, 75.0, False)
    assert costs.projected_spend(df, day(1), 74.9).first()["alert"]


def test_token_cost(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23), 1000, 500), (dt.datetime(2024, 1, 1, 1), 1000, None)],
                               "ts timestamp_ntz, p int, c int")
    assert tuple(costs.token_cost_daily(df, "ts", "p", "c").first()) == (day(0), 2000, 500, 0.004)
