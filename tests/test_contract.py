"""The driver's entry points, on the smallest tables."""

import pytest

import __spark_entry__ as contract

QUERIES = contract.queries()


def test_entry(spark, sf):
    df = contract.entry(spark)
    assert df.columns[:5] == ["user_id", "user_name", "username", "email", "total_posts"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    assert duckdb
    import check

    sql = contract.oracle_sql().get(name)
    line = check.compare(spark, check.oracle(sf), name, QUERIES[name], sql, sf)
    assert line.startswith(("ok", "rows")), line


@pytest.mark.parametrize("name", ["a1_fct_user_posts", "l3_merge_by_key", "j2_vector_top_k", "m1_session_aggregated"])
def test_no_quadratic_joins(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
