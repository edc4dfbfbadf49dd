"""Detection, masking, tokens, anonymity."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.bindings.base import EVENTS_AS_OF, query, raw_users, table
from lakeops.functions import masks, pii
from lakeops.operators import joins, privacy

SALT = "pepper"


re2 = pii.re2_pattern


_FINDINGS = "\nUNION ALL\n".join(
    f"""SELECT doc_id, ts, 'text' AS field, '{t}' AS type, unnest(range(len(m)))::INTEGER AS ordinal, unnest(m) AS value,
               unnest(p)::INTEGER AS position
        FROM (SELECT doc_id, ts, m, list_transform(range(len(m)), lambda i: list_sum(list_transform(g[1:i+1], lambda x: length(x)))
                     + coalesce(list_sum(list_transform(m[1:i], lambda x: length(x))), 0)) AS p
              FROM (SELECT doc_id, TIMESTAMP '2024-01-30 23:30:00' AS ts, regexp_extract_all(text, '{re2(rx)}', 0) AS m,
                           string_split_regex(text, '{re2(rx)}') AS g FROM documents))"""
    for t, rx in pii.PII_PATTERNS.items()
)


def _found(spark, sf):
    return privacy.detect_pii(table(spark, sf, "documents"), ["text"], ["doc_id"])


def _dated(spark, sf):
    return _found(spark, sf).withColumn("detected_at", F.lit("2024-01-30 23:30:00").cast("timestamp_ntz"))


@query(
    "x1_detect_pii",
    f"SELECT doc_id, field, type, ordinal, value, 0.9::DOUBLE AS confidence FROM ({_FINDINGS})",
)
def _(spark, sf):
    return _found(spark, sf)


@query("x2_match_positions", f"SELECT doc_id, type, ordinal, value, position FROM ({_FINDINGS})")
def _(spark, sf):
    out = privacy.detect_pii(table(spark, sf, "documents"), ["text"], ["doc_id"], with_position=True)
    return out.select("doc_id", "type", "ordinal", "value", "position")


_EMAILS = "(SELECT c_custkey, lower(replace(c_name, '#', '')) || '@example.com' AS email FROM customer)"


@query("x4_hash_pii", f"SELECT c_custkey AS id, sha256(email || '{SALT}') AS hashed FROM {_EMAILS}")
def _(spark, sf):
    return raw_users(spark, sf).select("id", masks.hash_pii(F.col("email"), SALT).alias("hashed"))


@query(
    "x5_hash_pii_md5",
    f"SELECT d.doc_id, md5(concat(l.quality::VARCHAR, '{SALT}')) AS hashed FROM documents d LEFT JOIN labels l USING (doc_id)",
)
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.select("doc_id", masks.hash_pii_md5(F.col("quality").cast("string"), SALT).alias("hashed"))


@query(
    "x6_partial_mask",
    """SELECT doc_id, CASE WHEN length(text) <= 7 THEN repeat('*', length(text)::INTEGER)
              ELSE left(text, 3) || repeat('*', (length(text) - 7)::INTEGER) || right(text, 4) END AS masked FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", masks.partial_mask(F.col("text"), 3, 4).alias("masked"))


@query(
    "x7_x8_x9_user_masks",
    """SELECT c_custkey AS id, left(lower(replace(c_name, '#', '')), 2) || '***@example.com' AS email,
              c_name AS not_an_email, '***-***-' || right(lpad(c_custkey::VARCHAR, 8, '0'), 4) AS phone,
              '***REDACTED***' AS secret FROM customer""",
)
def _(spark, sf):
    return raw_users(spark, sf).select(
        "id",
        masks.mask_email(F.col("email")).alias("email"),
        masks.mask_email(F.col("name")).alias("not_an_email"),
        masks.mask_phone(F.col("phone")).alias("phone"),
        masks.redact(F.col("name")).alias("secret"),
    )


@query(
    "x10_generalize",
    """SELECT o_orderkey,
              CASE WHEN n < 18 THEN '0-17' WHEN n < 30 THEN '18-29' WHEN n < 50 THEN '30-49' WHEN n < 65 THEN '50-64' ELSE '65+' END AS age_range,
              left(lpad(o_custkey::VARCHAR, 7, '0'), 3) || '****' AS zip, strftime(o_orderdate, '%Y-%m') AS month,
              strftime(o_orderdate, '%Y') AS year
       FROM (SELECT *, (o_totalprice / 5000)::INTEGER AS n FROM (SELECT o_orderkey, o_custkey, o_orderdate, floor(o_totalprice / 5000) * 5000 AS o_totalprice FROM orders))""",
)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        masks.generalize_age(F.floor(F.col("o_totalprice") / 5000)).alias("age_range"),
        masks.generalize_zip(F.lpad(F.col("o_custkey").cast("string"), 7, "0")).alias("zip"),
        masks.generalize_date(F.col("o_orderdate")).alias("month"),
        masks.generalize_date(F.col("o_orderdate"), "year").alias("year"),
    )


def _keep(c: str, n: int) -> str:
    return (
        f"CASE WHEN length({c}) <= {n} THEN repeat('*', length({c})::INTEGER) "
        f"ELSE repeat('*', (length({c}) - {n})::INTEGER) || right({c}, {n}) END"
    )


def _whole_value_sql() -> str:
    """Policy steps as nested selects: s1 hashes, every later one reads the one before."""
    sql = f"""SELECT doc_id, text, list_reduce(list_prepend(text, list_transform(range(len(regexp_extract_all(text, '{re2(pii.PII_PATTERNS["email"])}', 0))), lambda x: '')),
                     lambda acc, x: sha256(acc || '{SALT}')) AS v FROM documents"""
    for t, rx in list(pii.PII_PATTERNS.items())[1:]:
        step = {"keep4": _keep("v", 4), "redact": "'***REDACTED***'", "keep3": _keep("v", 3)}[
            masks.WHOLE_VALUE_POLICY.get(t, "keep3")
        ]
        sql = f"SELECT doc_id, text, CASE WHEN regexp_matches(text, '{re2(rx)}') THEN {step} ELSE v END AS v FROM ({sql})"
    return f"SELECT doc_id, v AS text FROM ({sql})"


@query("x11_mask_fields", _whole_value_sql())
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return privacy.mask_fields(docs, ["text"], SALT)


def _inline_sql(c: str) -> str:
    out = c
    for _, rx, replacement in masks.INLINE_REPLACEMENTS:
        out = f"regexp_replace({out}, '{re2(rx)}', '{replacement}', 'g')"
    return out


@query("x12_mask_inline", f"SELECT doc_id, {_inline_sql('text')} AS text FROM documents")
def _(spark, sf):
    return privacy.mask_texts(table(spark, sf, "documents").select("doc_id", "text"), ["text"])




def _token_sql(v: str) -> str:
    d = f"sha256('{SALT}' || chr(31) || {v})"
    return " || '-' || ".join(f"substr({d}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


@query("x13_tokenize", f"SELECT event_id, {_token_sql('user_id::VARCHAR')} AS user_id FROM events")
def _(spark, sf):
    out, _ = privacy.tokenize(table(spark, sf, "events"), "user_id", SALT, EVENTS_AS_OF)
    return out.select("event_id", "user_id")


@query(
    "x13_vault",
    f"""SELECT DISTINCT {_token_sql('user_id::VARCHAR')} AS token, user_id::VARCHAR AS value,
               TIMESTAMP '2024-01-31' + INTERVAL 90 DAY AS expires_at FROM events""",
)
def _(spark, sf):
    return privacy.tokenize(table(spark, sf, "events"), "user_id", SALT, EVENTS_AS_OF)[1]


@query("j5_resolve_tokens", "SELECT event_id, user_id::VARCHAR AS original FROM events")
def _(spark, sf):
    out, vault = privacy.tokenize(table(spark, sf, "events"), "user_id", SALT, EVENTS_AS_OF)
    resolved = joins.resolve_tokens(out, vault, "user_id", "2024-03-01")
    return resolved.select("event_id", "original")


@query(
    "x14_users_masked",
    f"""SELECT c_custkey AS user_id, left(lower(replace(c_name, '#', '')), 2) || '***@example.com' AS email_masked,
               '***-***-' || right(lpad(c_custkey::VARCHAR, 8, '0'), 4) AS phone_masked,
               md5(lower(replace(c_name, '#', '')) || '@example.com{SALT}') AS email_hashed,
               c_mktsegment AS first_name, left(c_name, 1) || '.' AS last_name_initial,
               CASE WHEN c_nationkey * 4 < 18 THEN '0-17' WHEN c_nationkey * 4 < 30 THEN '18-29' WHEN c_nationkey * 4 < 50 THEN '30-49'
                    WHEN c_nationkey * 4 < 65 THEN '50-64' ELSE '65+' END AS age_range,
               left(lpad(c_custkey::VARCHAR, 7, '0'), 3) || '****' AS zip_code_generalized, 'Tokyo' AS city, 'JP' AS country,
               TIMESTAMP '2024-02-01' AS created_at
        FROM customer""",
)
def _(spark, sf):
    users = raw_users(spark, sf).select(
        F.col("id").alias("user_id"), "email", "phone",
        F.col("address.segment").alias("first_name"), F.col("name").alias("last_name"),
        (F.col("address.nation") * 4).alias("age"),
        F.lpad(F.col("id").cast("string"), 7, "0").alias("zip_code"),
        F.lit("Tokyo").alias("city"), F.lit("JP").alias("country"),
        F.col("ingestion_timestamp").alias("created_at"),
    )
    return privacy.users_masked(users, SALT)


@query(
    "a13_pii_daily_stats",
    f"""SELECT ts::DATE AS date, type AS pii_type, count(*) AS detections, count(DISTINCT field) AS affected_fields
        FROM ({_FINDINGS}) GROUP BY 1, 2""",
)
def _(spark, sf):
    return privacy.pii_daily_stats(_dated(spark, sf))


@query(
    "x15_pii_audit_log",
    f"""SELECT TIMESTAMP '2024-01-31' AS timestamp, 'pii_masking' AS operation, 'pipeline' AS "user", 'documents' AS resource,
               'text' AS fields_masked, 'inline' AS masking_method, 'GDPR,CCPA' AS compliance, count(*)::BIGINT AS findings_count
        FROM ({_FINDINGS})""",
)
def _(spark, sf):
    return privacy.pii_audit_log(_found(spark, sf), "documents", "pipeline", "inline", EVENTS_AS_OF)


@query(
    "x16_pii_rate_alert",
    f"SELECT count(*) AS detections, count(*) > 1000 AS alert FROM ({_FINDINGS}) WHERE ts > TIMESTAMP '2024-01-30 23:00:00'",
)
def _(spark, sf):
    return privacy.pii_rate_alert(_dated(spark, sf), EVENTS_AS_OF)


@query(
    "x17_k_anonymity",
    "SELECT c_nationkey, c_mktsegment, count(*) AS group_size FROM customer GROUP BY 1, 2 HAVING count(*) < 12",
)
def _(spark, sf):
    return privacy.k_anonymity(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"], 12)


@query(
    "x17_k_anonymity_summary",
    """SELECT count(*) AS groups, count(*) FILTER (WHERE n < 12) AS violating_groups,
              coalesce(sum(n) FILTER (WHERE n < 12), 0)::BIGINT AS violating_rows, min(n) AS smallest_group
       FROM (SELECT count(*) AS n FROM customer GROUP BY c_nationkey, c_mktsegment)""",
)
def _(spark, sf):
    return privacy.k_anonymity_summary(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"], 12)
