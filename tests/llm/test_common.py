"""Row numbers over range partitions."""

import random

from lakeops.llm import common


def test_numbers_follow_the_order(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, 1, 1, 1, 2, 3]), rnd.choice(["a", "b", None]), i) for i in range(3_000)]  # many ties
    df = spark.createDataFrame(rows, "k int, s string, part int").repartition(7)
    got = common.numbered(df, ["k", "s"], "place", "numbers")
    assert got.columns == ["k", "s", "part", "place"]
    out = sorted(got.collect(), key=lambda r: r.place)
    assert [r.place for r in out] == list(range(3_000)) and sorted(r.part for r in out) == list(range(3_000))
    order = [(r.k is not None, r.k or 0, r.s is not None, r.s or "") for r in out]
    assert order == sorted(order)


def test_equal_rows_spread_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4_000).selectExpr("7 AS k")
        got = common.numbered(df, ["k"], "n", "numbers")
        assert sorted(r.n for r in got.collect()) == list(range(4_000))
        assert len([f for f in got.inputFiles() if "part-" in f]) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_no_rows(spark):
    assert common.numbered(spark.createDataFrame([], "k int"), ["k"], "n", "numbers").collect() == []
