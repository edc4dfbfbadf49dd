"""Expectations, suites, anomaly tests and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.bindings.base import ORACLES, averaged, EVENTS_AS_OF, POSTS_SQL, USERS_SQL, query, raw_posts, raw_users, rounded, table
from lakeops.functions import masks, pii
from lakeops.operators import anomaly, checks, profile, suite
from lakeops.operators.checks import Expectation as E, Suite
from lakeops.operators.staging import stage_posts, stage_users
from lakeops.plans.suites import POSTS_SUITE, USERS_SUITE
from lakeops.session import scratch_dir

AS_OF = EVENTS_AS_OF


def result_sql(source: str, rows: list[tuple[int, str, str | None, str, str, str, str]]) -> str:
    """Oracle for a suite: (position, name, column, success, elements, unexpected, observed)."""
    parts = []
    for at, name, column, success, n, bad, observed in rows:
        quoted = "NULL" if column is None else f"'{column}'"
        parts.append(
            f"""SELECT {at} AS position, '{name}' AS expectation, {quoted}::VARCHAR AS "column",
                       ({success})::BOOLEAN AS success, ({n})::BIGINT AS element_count,
                       ({bad})::BIGINT AS unexpected_count, ({observed})::VARCHAR AS observed FROM {source}"""
        )
    return "\nUNION ALL\n".join(parts)


def map_row(at: int, name: str, column: str, ok: str, mostly: float = 1.0, n: str | None = None):
    n = n or f"count({column})"
    bad = f"count(*) FILTER (WHERE NOT ({ok}))"
    return (at, name, column, f"{n} = 0 OR ({n} - {bad}) / {n} >= {mostly}", n, bad, "NULL")


def shown(results):
    return results.select(
        "position", "expectation", "column", "success", "element_count", "unexpected_count", "observed"
    )


_DOCS = Suite(
    "documents",
    (
        E("not_null", "lang"),
        E("length_between", "text", {"low": 50, "high": 5000}, mostly=0.5),
        E("values_between", "n_chars", {"low": 100}),
        E("in_set", "lang", {"values": ["en", "de", "fr"]}, mostly=0.9),
        E("not_empty_string", "source"),
        E("not_contains_pii", "text", mostly=0.5),
        E("matches_regex", "source", {"regex": r"^src[0-9]$"}, mostly=0.4),
    ),
)
_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"


@query("q3_q9_suite_maps")
def _(spark, sf):
    return shown(suite.run_suite(table(spark, sf, "documents"), _DOCS))


def _pii_free(column: str) -> str:
    return " AND ".join(
        f"NOT regexp_matches({column}, '{pii.re2_pattern(p)}')" for p in pii.CHECKED_PATTERNS.values()
    )


ORACLES["q3_q9_suite_maps"] = result_sql(
    "documents",
    [
        map_row(0, "not_null", "lang", "lang IS NOT NULL", n="count(*)"),
        map_row(1, "length_between", "text", "length(text) BETWEEN 50 AND 5000", 0.5),
        map_row(2, "values_between", "n_chars", "n_chars >= 100"),
        map_row(3, "in_set", "lang", "lang IN ('en', 'de', 'fr')", 0.9),
        map_row(4, "not_empty_string", "source", "trim(source) <> ''"),
        map_row(5, "not_contains_pii", "text", _pii_free("text"), 0.5),
        map_row(6, "matches_regex", "source", "regexp_matches(source, '^src[0-9]$')", 0.4),
    ],
)


@query(
    "q1_q10_row_count_and_moments",
    """SELECT 0 AS position, count(*)::BIGINT AS element_count, count(*)::DOUBLE AS observed,
              count(*) BETWEEN 1 AND 1000000 AS success FROM lineitem
       UNION ALL SELECT 1, count(l_quantity), round(avg(l_quantity) + 1e-9, 6), avg(l_quantity) BETWEEN 20 AND 30 FROM lineitem
       UNION ALL SELECT 2, count(l_quantity), round(stddev_samp(l_quantity), 6),
                        stddev_samp(l_quantity) BETWEEN 0 AND 10 FROM lineitem
       UNION ALL SELECT 3, count(l_extendedprice), round(median(l_extendedprice), 6),
                        median(l_extendedprice) BETWEEN 0 AND 100000 FROM lineitem""",
)
def _(spark, sf):
    s = Suite(
        "lines",
        (
            E("row_count_between", kwargs={"low": 1, "high": 1_000_000}),
            E("mean_between", "l_quantity", {"low": 20, "high": 30}),
            E("stdev_between", "l_quantity", {"low": 0, "high": 10}),
            E("median_between", "l_extendedprice", {"low": 0, "high": 100_000}),
        ),
    )
    out = suite.run_suite(table(spark, sf, "lineitem"), s)
    return out.select(
        "position", "element_count", F.round(F.col("observed").cast("double"), 6).alias("observed"), "success"
    )


@query(
    "q4_unique",
    """WITH c AS (SELECT p_name AS v, count(*) AS n FROM part GROUP BY 1), k AS (SELECT o_orderkey AS v, count(*) AS n FROM orders GROUP BY 1)
       SELECT 0 AS position, sum(n)::BIGINT AS element_count,
              coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS unexpected_count,
              coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0 AS success FROM c
       UNION ALL SELECT 1, sum(n)::BIGINT, coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT,
              coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0 FROM k""",
)
def _(spark, sf):
    cols = ["position", "element_count", "unexpected_count", "success"]
    part = suite.run_suite(table(spark, sf, "part"), Suite("part", (E("unique", "p_name"),)))
    orders = suite.run_suite(table(spark, sf, "orders"), Suite("orders", (E("unique", "o_orderkey"),)))
    return part.select(cols).unionByName(orders.withColumn("position", F.lit(1)).select(cols))


@query(
    "q7_matches_regex",
    result_sql(
        "(SELECT lower(replace(c_name, '#', '')) || '@example.com' AS email FROM customer)",
        [map_row(0, "matches_regex", "email", r"regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')")],
    ),
)
def _(spark, sf):
    users = stage_users(raw_users(spark, sf))
    return shown(suite.run_suite(users, Suite("u", (E("matches_regex", "email", {"regex": checks.EMAIL_REGEX}),))))


@query(
    "q11_dateutil_parseable",
    result_sql(
        "(SELECT o_orderstatus || substr(o_orderdate::DATE::VARCHAR, 2) AS text FROM orders)",
        [map_row(0, "dateutil_parseable", "text", "false", 0.0)],
    ),
)
def _(spark, sf):
    dates = table(spark, sf, "orders").select(
        F.concat("o_orderstatus", F.substr(F.to_date("o_orderdate").cast("string"), F.lit(2))).alias("text")
    )
    return shown(suite.run_suite(dates, Suite("d", (E("dateutil_parseable", "text", mostly=0.0),))))


@query(
    "q11_dates_that_parse",
    result_sql(
        "(SELECT o_orderkey, 'x' AS text FROM orders)",
        [map_row(0, "dateutil_parseable", "text", "o_orderkey % 3 = 0", 0.3)],
    ),
)
def _(spark, sf):
    day = F.to_date("o_orderdate")
    good = F.when(F.col("o_orderkey") % 2 == 0, day.cast("string")).otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    dates = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, good).otherwise(F.concat("o_orderstatus", F.substr(day.cast("string"), F.lit(2)))).alias("text"))
    return shown(suite.run_suite(dates, Suite("d", (E("dateutil_parseable", "text", mostly=0.3),))))


@query(
    "q12_increasing",
    """WITH s AS (SELECT event_id AS v, lag(event_id) OVER (ORDER BY ts, event_id) AS b FROM events)
       SELECT 'increasing' AS expectation, count(*)::BIGINT AS element_count,
              count(*) FILTER (WHERE v < b)::BIGINT AS unexpected_count, count(*) FILTER (WHERE v < b) = 0 AS success
       FROM s""",
)
def _(spark, sf):
    s = Suite("e", (E("increasing", "event_id", {"order_by": "ts"}),))
    out = suite.run_suite(table(spark, sf, "events"), s)
    return out.select("expectation", "element_count", "unexpected_count", "success")


@query(
    "q15_postal_code",
    result_sql(
        "(SELECT lpad(c_nationkey::VARCHAR, 3, '0') || '-' || c_custkey AS code FROM customer)",
        [map_row(0, "postal_code", "code", r"regexp_matches(code, '^\d{3}-\d{4}$')", 0.5)],
    ),
)
def _(spark, sf):
    code = F.concat(F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.lit("-"), F.col("c_custkey").cast("string"))
    codes = table(spark, sf, "customer").select(code.alias("code"))
    return shown(suite.run_suite(codes, Suite("c", (E("postal_code", "code", mostly=0.5),))))


@query(
    "q16_freshness",
    """SELECT max(ts) AS newest,
              round((epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts))) / 3600000000.0, 6) AS age_hours,
              CASE WHEN epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts)) > 48 * 3600000000 THEN 'error'
                   WHEN epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts)) > 24 * 3600000000 THEN 'warn'
                   ELSE 'pass' END AS status
       FROM events""",
)
def _(spark, sf):
    return rounded(suite.freshness(table(spark, sf, "events"), "ts", "2024-02-01 12:00:00"), age_hours=6)


_DAYS = "(SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY))::DATE AS date)"
_FLAG = """
    SELECT {keys} date, {value} AS {name}, round(m, 6) AS baseline_mean, round(s, 6) AS baseline_std,
           round(({value} - m) / nullif(s, 0), 6) AS z_score,
           coalesce(abs(round(({value} - m) / nullif(s, 0), 9)) > {z}, false) AS is_anomaly {more}
    FROM (SELECT *, avg({value}) OVER w AS m, stddev_samp({value}) OVER w AS s, coalesce(sum({value}) OVER w, 0) AS seen
          FROM f WINDOW w AS ({part} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
_Z = {"baseline_mean": 6, "baseline_std": 6, "z_score": 6}


@query(
    "q18_volume_anomalies",
    f"""WITH f AS (SELECT d.date, count(e.ts) AS n FROM {_DAYS} d LEFT JOIN events e ON e.ts::DATE = d.date GROUP BY 1)"""
    + _FLAG.format(keys="", value="n", name="row_count", z=2.0, part="", more=""),
)
def _(spark, sf):
    return rounded(anomaly.volume_anomalies(table(spark, sf, "events"), "ts", AS_OF, z_threshold=2.0), **_Z)


@query(
    "q19_dimension_anomalies",
    f"""WITH k AS (SELECT DISTINCT user_id FROM events), g AS (SELECT user_id, date FROM k, {_DAYS} d),
        f AS (SELECT g.user_id, g.date, count(e.ts) AS n FROM g LEFT JOIN events e
              ON e.ts::DATE = g.date AND e.user_id = g.user_id GROUP BY 1, 2)"""
    + _FLAG.format(
        keys="user_id,", value="n", name="row_count", z=3.0, part="PARTITION BY user_id",
        more=", seen = 0 AND n > 0 AS is_new",
    ),
)
def _(spark, sf):
    return rounded(anomaly.dimension_anomalies(table(spark, sf, "events"), "ts", ["user_id"], AS_OF), **_Z)


@query(
    "q20_column_anomalies",
    """WITH d AS (SELECT ts::DATE AS date, avg(length(props)) AS "avg", min(length(props))::DOUBLE AS "min",
                         max(length(props))::DOUBLE AS "max", avg(CASE WHEN props IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS null_rate
                  FROM events WHERE ts < TIMESTAMP '2024-01-31' GROUP BY 1),
       f AS (UNPIVOT d ON "avg", "min", "max", null_rate INTO NAME metric VALUE v)"""
    + _FLAG.format(
        keys="metric,", value="v", name="value_", z=2.0, part="PARTITION BY metric", more="",
    ).replace("v AS value_", "round(v, 6) AS value"),
)
def _(spark, sf):
    out = anomaly.column_anomalies(
        table(spark, sf, "events"), "ts", F.length("props"), AS_OF, z_threshold=2.0
    )
    return rounded(out, value=6, **_Z)


def _unique_row(at: int, column: str, source: str):
    n = f"count({column})"
    bad = f"(SELECT coalesce(sum(k), 0) FROM (SELECT count(*) AS k FROM ({source}) WHERE {column} IS NOT NULL GROUP BY {column}) WHERE k > 1)"
    return (at, "unique", column, f"{bad} = 0", n, bad, "NULL")


def _not_null(at: int, column: str):
    return map_row(at, "not_null", column, f"{column} IS NOT NULL", n="count(*)")


def _rows(at: int, most: int):
    return (at, "row_count_between", None, f"count(*) BETWEEN 1 AND {most}", "count(*)", "NULL", "count(*)")


def _schema_row(at: int, name: str, column: str | None, observed: str):
    return (at, name, column, "count(*) >= 0", "NULL", "NULL", f"max('{observed}')")


# the staged model's own columns
_POSTS_RESULTS = result_sql(
    f"({POSTS_SQL})",
    [
        _rows(0, 1_000_000), _schema_row(1, "columns_match_ordered_list", None, "post_id,user_id,title,body,loaded_at"),
        _not_null(2, "post_id"), _unique_row(3, "post_id", POSTS_SQL), _not_null(4, "user_id"), _schema_row(5, "type_in_list", "user_id", "bigint"),
        _not_null(6, "title"), map_row(7, "length_between", "title", "length(title) BETWEEN 1 AND 500"), _not_null(8, "body"),
        map_row(9, "length_between", "body", "length(body) BETWEEN 1 AND 10000"), _not_null(10, "loaded_at"),
        _schema_row(11, "of_type", "loaded_at", "timestamp"),
    ],
)
_USERS_RESULTS = result_sql(
    f"({USERS_SQL})",
    [
        _rows(0, 100_000), _schema_row(1, "columns_match_set", None, "user_id"), _not_null(2, "user_id"), _unique_row(3, "user_id", USERS_SQL),
        _not_null(4, "username"), _unique_row(5, "username", USERS_SQL), _not_null(6, "email"), _unique_row(7, "email", USERS_SQL),
        map_row(8, "matches_regex", "email", r"regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')"),
        map_row(9, "length_between", "email", "length(email) BETWEEN 5 AND 255"), _not_null(10, "loaded_at"),
    ],
)


@query("q21_run_suite", _POSTS_RESULTS)
def _(spark, sf):
    return shown(suite.run_suite(stage_posts(raw_posts(spark, sf)), POSTS_SUITE))


@query("q21_suite_at_write", _POSTS_RESULTS)
def _(spark, sf):
    """The same results, taken while the model is written."""
    path = scratch_dir(spark, "posts")

    def write(posts):
        posts.write.parquet(path)
        return spark.read.schema(posts.schema).parquet(path)

    return shown(suite.write_checked(stage_posts(raw_posts(spark, sf)), POSTS_SUITE, write))


def _checkpoint(spark, sf):
    return suite.run_checkpoint(
        spark,
        [
            ("api_posts", stage_posts(raw_posts(spark, sf)), POSTS_SUITE),
            ("api_users", stage_users(raw_users(spark, sf)), USERS_SUITE),
            ("documents", table(spark, sf, "documents"), _DOCS),
        ],
        AS_OF,
    )


@query(
    "q22_run_checkpoint",
    f"""SELECT bool_and(success) AS success, count(*) AS evaluated, count(*) FILTER (WHERE success) AS successful,
               count(*) FILTER (WHERE NOT success) AS unsuccessful
        FROM ({_POSTS_RESULTS} UNION ALL {_USERS_RESULTS} UNION ALL {ORACLES["q3_q9_suite_maps"]})""",
)
def _(spark, sf):
    return suite.checkpoint_outcome(_checkpoint(spark, sf))


@query(
    "q23_quality_summary",
    """SELECT count(*) AS total_validations, count(*) FILTER (WHERE o_orderstatus <> 'F') AS passed,
              count(*) FILTER (WHERE o_orderstatus = 'F') AS failed,
              round(count(*) FILTER (WHERE o_orderstatus <> 'F') / count(*) * 100, 6) AS success_rate,
              count(DISTINCT o_orderpriority) AS datasets, max(o_orderdate) AS last_check FROM orders""",
)
def _(spark, sf):
    return rounded(suite.quality_summary(_history(spark, sf)), success_rate=6)


def _history(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("dataset"), (F.col("o_orderstatus") != "F").alias("success"),
        F.col("o_orderdate").alias("run_at"),
    )


@query(
    "q23_quality_trend",
    """SELECT o_orderdate::DATE AS date, count(*) FILTER (WHERE o_orderstatus <> 'F') AS passed,
              count(*) FILTER (WHERE o_orderstatus = 'F') AS failed FROM orders GROUP BY 1""",
)
def _(spark, sf):
    return suite.quality_trend(_history(spark, sf))


@query(
    "q23_failures_by_dataset",
    "SELECT o_orderpriority AS dataset, count(*) AS failures FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
)
def _(spark, sf):
    return suite.failures_by_dataset(_history(spark, sf))


@query("q24_failing_rows", "SELECT * FROM part WHERE NOT (p_size BETWEEN 5 AND 40)")
def _(spark, sf):
    return checks.failing_rows(table(spark, sf, "part"), E("values_between", "p_size", {"low": 5, "high": 40}))


@query(
    "q24_failing_rows_unique",
    "SELECT * FROM part WHERE p_name IN (SELECT p_name FROM part GROUP BY 1 HAVING count(*) > 1)",
)
def _(spark, sf):
    return checks.failing_rows(table(spark, sf, "part"), E("unique", "p_name"))


@query(
    "q25_profile",
    """SELECT * FROM (VALUES (0, 'event_id', 'bigint'), (1, 'ts', 'timestamp_ntz'), (2, 'user_id', 'bigint'),
                             (3, 'event_type', 'string'), (4, 'value', 'double'), (5, 'props', 'string')) t(position, "column", type),
       LATERAL (SELECT CASE position WHEN 0 THEN count(event_id) WHEN 1 THEN count(ts) WHEN 2 THEN count(user_id)
                       WHEN 3 THEN count(event_type) WHEN 4 THEN count(value) ELSE count(props) END AS non_null_count,
                       count(*) - CASE position WHEN 0 THEN count(event_id) WHEN 1 THEN count(ts) WHEN 2 THEN count(user_id)
                       WHEN 3 THEN count(event_type) WHEN 4 THEN count(value) ELSE count(props) END AS null_count FROM events)""",
)
def _(spark, sf):
    return profile.profile(table(spark, sf, "events"))


@query(
    "q25_describe",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}) + 1e-9, 6) AS mean, round(stddev_samp({c}), 6) AS std,
                   min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
                   round(quantile_cont({c}, 0.75), 6) AS q75, max({c})::DOUBLE AS max FROM part"""
        for c in ("p_size", "p_retailprice")
    ),
)
def _(spark, sf):
    out = profile.describe(table(spark, sf, "part"), ["p_size", "p_retailprice"], exact=True)
    return averaged(rounded(out, std=6, q25=6, q50=6, q75=6), mean=6)


@query(
    "q26_quality_metrics",
    """SELECT count(*) AS total_rows, 3 AS total_columns,
              count(*) - (SELECT count(*) FROM (SELECT DISTINCT lang, source, t FROM (
                SELECT lang, source, CASE WHEN n_chars > 500 THEN n_chars END AS t FROM documents))) AS duplicate_rows,
              count(*) FILTER (WHERE n_chars <= 500) AS missing_values,
              (count(*) FILTER (WHERE n_chars <= 500) > 0)::INTEGER AS columns_with_missing
       FROM documents""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select(
        "lang", "source", F.when(F.col("n_chars") > 500, F.col("n_chars")).alias("t")
    )
    return profile.quality_metrics(docs)


@query(
    "q26_missing_by_column",
    """SELECT 'toxic' AS "column", count(*) - count(l.toxic) AS missing_count FROM documents d LEFT JOIN labels l USING (doc_id)
       HAVING count(*) > count(l.toxic)
       UNION ALL SELECT 'quality', count(*) - count(l.quality) FROM documents d LEFT JOIN labels l USING (doc_id)
       HAVING count(*) > count(l.quality)""",
)
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return profile.missing_by_column(d)


@query(
    "q27_column_profile",
    """SELECT 'p_name' AS "column", count(p_name) AS count, count(DISTINCT p_name) AS unique_values,
              count(*) - count(p_name) AS missing, 'string' AS type FROM part""",
)
def _(spark, sf):
    return profile.column_profile(table(spark, sf, "part"), "p_name")


@query(
    "q28_value_counts",
    "SELECT p_type, count(*) AS count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
)
def _(spark, sf):
    return profile.value_counts(table(spark, sf, "part"), "p_type")


@query(
    "q28_histogram",
    """WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
       c AS (SELECT least(floor(20 * (value - lo) / (hi - lo))::BIGINT + 1, 20) AS bin, count(*) AS n FROM events, b GROUP BY 1)
       SELECT g.bin, round(lo + (hi - lo) / 20 * (g.bin - 1), 6) AS bin_start, round(lo + (hi - lo) / 20 * g.bin, 6) AS bin_end,
              coalesce(n, 0) AS count
       FROM (SELECT unnest(generate_series(1, 20)) AS bin) g LEFT JOIN c USING (bin), b""",
)
def _(spark, sf):
    return rounded(profile.histogram(table(spark, sf, "events"), "value"), bin_start=6, bin_end=6)


@query(
    "q29_ad_hoc_sql",
    "SELECT event_type, count(*) AS n FROM events WHERE value > 10 GROUP BY 1",
)
def _(spark, sf):
    return profile.ad_hoc_sql(
        "SELECT event_type, count(*) AS n FROM {df} WHERE value > 10 GROUP BY 1", df=table(spark, sf, "events")
    )


@query(
    "q14_masked_texts_are_clean",
    """SELECT count(*) AS documents, 0::BIGINT AS with_email FROM documents""",
)
def _(spark, sf):
    text = masks.mask_inline(F.col("text"))
    address = text.rlike(_EMAIL.replace("+@", "+@(?!\\*)"))
    return table(spark, sf, "documents").agg(
        F.count("*").alias("documents"), F.count_if(address).alias("with_email")
    )


@query(
    "q31_own_expectation",
    """SELECT 0 AS position, count(*) AS element_count, count(*) FILTER (WHERE o_orderkey % 4 <> 0) AS unexpected_count,
              count(*) FILTER (WHERE o_orderkey % 4 <> 0) = 0 AS success FROM orders""",
)
def _(spark, sf):
    checks.register_expectation("multiple_of", lambda c, by: c % by == 0)
    s = Suite("orders", (E("multiple_of", "o_orderkey", {"by": 4}),))
    return suite.run_suite(table(spark, sf, "orders"), s).select("position", "element_count", "unexpected_count", "success")


@query("q30_observed_run", "SELECT 'events' AS job, count(*) AS rows_written FROM events")
def _(spark, sf):
    seen, observation = suite.observe_run(table(spark, sf, "events"), "events")
    path = scratch_dir(spark, "observed")
    seen.write.parquet(path)
    rows = observation.get["rows"]
    return suite.run_record(
        spark, "run-1", "events", "COMPLETE", AS_OF, AS_OF, rows, rows, [sf], [path]).select("job", "rows_written")
