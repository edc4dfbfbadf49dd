import hashlib
import random
import re
import string

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.functions import casts, masks, pii, timeparts
from lakeops.functions.similarity import similarity


def one(spark, value, build, ddl="string"):
    df = spark.createDataFrame([(value,)], f"v {ddl}")
    return df.select(build(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text,expected",
    [("12", 12), ("+7", 7), ("-7", -7), (" 12", 0), ("12 ", 0), ("1.5", 0), ("x", 0), ("", 0), (None, 0),
     ("12\n", 0), ("99999999999999999999", 0)],
)
def test_lenient_long(spark, text, expected):
    assert one(spark, text, casts.lenient_long) == expected


@pytest.mark.parametrize(
    "text,expected", [("1.5", 1.5), (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0), ("1d", 0.0), ("2f", 0.0), ("nope", 0.0),
                      (" 1", 0.0), (None, 0.0), ("-inf", float("-inf"))],
)
def test_lenient_double(spark, text, expected):
    assert one(spark, text, casts.lenient_double) == expected


def test_ratio_of_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(casts.ratio(F.col("a"), F.col("b"))).collect()] == [None, None, 0.25]


def test_seconds_between_counts_boundaries(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.9' a, timestamp_ntz'2024-01-01 00:00:02.1' b")
    assert df.select(timeparts.seconds_between(F.col("a"), F.col("b"))).first()[0] == 2


def test_months_before():
    import datetime as dt

    assert timeparts.months_before(dt.date(2024, 3, 31), 1) == dt.date(2024, 2, 29)
    assert timeparts.months_before(dt.date(2024, 1, 15), 3) == dt.date(2023, 10, 15)
    assert timeparts.months_before(dt.date(2024, 12, 31), 12) == dt.date(2023, 12, 31)


def test_time_filter_reaches_parquet(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int)) ts, id FROM range(40)").write.parquet(path)
    df = spark.read.parquet(path)
    kept = df.filter(timeparts.since(df, "ts", "2024-01-31", days=7))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-24" in plan
    assert kept.count() == 17


def test_date_column_rounds_up_to_midnight(spark):
    df = spark.sql("SELECT date'2024-01-24' d UNION ALL SELECT date'2024-01-25'")
    assert df.filter(timeparts.not_before(df, "d", "2024-01-24 08:00:00")).count() == 1
    assert df.filter(timeparts.after(df, "d", "2024-01-24 08:00:00")).count() == 1


# ------------------------------------------------------------------ masks

@pytest.mark.parametrize(
    "value,start,end,expected",
    [
        ("+1-555-123-4567", 3, 4, "+1-********4567"),
        ("john.doe@example.com", 0, 4, "*" * 16 + ".com"),
        ("1234-5678-9012-3456", 0, 4, "*" * 15 + "3456"),
        ("abcd", 0, 4, "****"),
        ("", 0, 4, ""),
        ("abcdef", 2, 0, "ab****"),
        (None, 0, 4, None),
    ],
)
def test_partial_mask(spark, value, start, end, expected):
    assert one(spark, value, lambda c: masks.partial_mask(c, start, end)) == expected


def test_partial_mask_keeps_length(spark):
    texts = ["".join(random.Random(i).choices(string.printable + "éü漢", k=i % 23)) for i in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(masks.partial_mask(F.col("v"), 2, 3)).collect()]
    assert [len(g) for g in got] == [len(t) for t in texts]


def test_hashes(spark):
    sha = hashlib.sha256(b"user@example.comsalt").hexdigest()
    assert one(spark, "user@example.com", lambda c: masks.hash_pii(c, "salt")) == sha
    assert one(spark, None, lambda c: masks.hash_pii(c, "salt")) is None
    assert one(spark, None, lambda c: masks.hash_pii_md5(c, "s")) == hashlib.md5(b"s").hexdigest()


@pytest.mark.parametrize(
    "value,expected",
    [("john@example.com", "jo***@example.com"), ("j@x.io", "j***@x.io"), ("no address", "no address"),
     ("a@b.com\n", "a@b.com\n"), (None, None)],
)
def test_mask_email(spark, value, expected):
    assert one(spark, value, masks.mask_email) == expected


def test_other_masks(spark):
    assert one(spark, "090-1234-5678", masks.mask_phone) == "***-***-5678"
    assert one(spark, None, masks.mask_phone) is None
    assert one(spark, "x", masks.redact) == "***REDACTED***"
    assert one(spark, None, masks.redact) is None
    assert one(spark, "1234567", masks.generalize_zip) == "123****"
    assert one(spark, "2024-03-05", lambda c: masks.generalize_date(c.cast("date"))) == "2024-03"
    assert one(spark, "2024-03-05", lambda c: masks.generalize_date(c.cast("date"), "year")) == "2024"
    assert one(spark, "2024-03-05", lambda c: masks.generalize_date(c.cast("date"), "day")) == "2024-03-05"


def test_age_bands(spark):
    ages = [None, 0, 17, 18, 29, 30, 49, 50, 64, 65, 101]
    df = spark.createDataFrame([(a,) for a in ages], "v int")
    assert [r[0] for r in df.select(masks.generalize_age(F.col("v"))).collect()] == [
        None, "0-17", "0-17", "18-29", "18-29", "30-49", "30-49", "50-64", "50-64", "65+", "65+",
    ]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("Email: test@example.com, SSN: 123-45-6789", "Email: ***@***.com, SSN: ***-**-****"),
        ("card 1234 5678 9012 3456 end", "card ****-****-****-**** end"),
        ("call 555-123-4567 now", "call ***-***-**** now"),
        ("nothing here", "nothing here"),
        (None, None),
    ],
)
def test_mask_inline(spark, text, expected):
    assert one(spark, text, masks.mask_inline) == expected


def test_whole_value_policy(spark):
    def sha(value, n=1):
        for _ in range(n):
            value = hashlib.sha256((value + "s").encode()).hexdigest()
        return value

    def mask(value):
        return one(spark, value, lambda c: masks.mask_whole_value(c, "s"))

    assert mask("plain words") == "plain words"
    assert mask(None) is None
    assert mask("a@b.com") == sha("a@b.com")
    assert mask("a@b.com c@d.com") == sha("a@b.com c@d.com", 2)
    # phone keeps four, then the postal code and so on keep three
    assert mask("555-123-4567") == "*********567"
    assert mask("AB1234567 ") == "***REDACTED***"
    # an SSN redacts; no later type is found in this value
    assert mask("123-45-6789") == "***REDACTED***"
    # address and passport: hashed first, then redacted
    assert mask("x@y.org AB1234567") == "***REDACTED***"
    assert mask("10.20.30.40") == "********.40"


# ------------------------------------------------------------------ detection

def python_matches(text, pattern):
    wide = "\\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
    ascii_blank = pattern.replace(r"[\s", f"[{wide}").replace(r"\s?", f"[{wide}]?")
    return [(m.group(0), m.start()) for m in re.finditer(ascii_blank, text, flags=re.ASCII)]


TEXTS = [
    "Contact me at john@example.com or 555-123-4567",
    "éjohn@example.com and ünder_score@x.org, a@b.c|d",
    "1234567890123456 4111-1111-1111-1111 1234 5678 9012",
    "SSN 123-45-6789x 123-45-6789 9123-45-6789",
    "AB1234567 XAB1234567 AB12345678 éAB1234567",
    "192.168.0.1 1.2.3.4.5 v1.2.3.4 999.999.999.999",
    "123-4567 〒100-0001 0123-4567 03-1234-5678",
    "+1-(555) 123.4567 (555)123-4567 +1555 123 4567",
    "1234 5678　9012 1234 5678 9012 3456",
    "", "no digits at all", "a@b", "@@@ 12 3. 4",
]


@pytest.mark.parametrize("pii_type", list(pii.PII_PATTERNS))
def test_detection_equals_regex_semantics(spark, pii_type):
    rng = random.Random(7)
    alphabet = "0123456789-. +()@aZé_\u00a0\u3000"
    texts = TEXTS + ["".join(rng.choices(alphabet, k=60)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = df.select("i", F.inline(pii.placed_findings(F.col("t"), (pii_type,)))).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["i"], r["ordinal"])):
        got.setdefault(r["i"], []).append((r["value"], r["position"]))
    want = {i: m for i, t in enumerate(texts) if (m := python_matches(t, pii.PII_PATTERNS[pii_type]))}
    assert got == want


def test_findings_without_position_agree(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    a = df.select(F.inline(pii.findings(F.col("t")))).collect()
    b = df.select(F.inline(pii.placed_findings(F.col("t")))).drop("position").collect()
    assert a == b


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789-.@aZé_ +(", max_size=40), min_size=1, max_size=20))
def test_contains_pii_agrees_with_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in sorted(df.select("i", pii.contains_pii(F.col("t"))).collect())]
    want = [any(python_matches(t, p) for p in pii.CHECKED_PATTERNS.values()) for t in texts]
    assert got == want


def test_contains_pii_of_null(spark):
    assert one(spark, None, pii.contains_pii) is None


def test_sensitive_names():
    assert pii.is_sensitive_name("Customer_Email")
    assert pii.is_sensitive_name("description")  # contains "ip"
    assert not pii.is_sensitive_name("amount")
    assert pii.suggested_masking("user_email") == "hash"
    assert pii.suggested_masking("last_name") == "pseudonymize"
    assert pii.suggested_masking("city") == "none"


# ------------------------------------------------------------------ similarity

def test_similarity(spark):
    df = spark.sql("SELECT array(3f, 4f) a, array(4f, 3f) b, array(0f, 0f) z, array(1f) s")
    a, b = F.col("a"), F.col("b")
    row = df.select(
        similarity(a, b), similarity(a, b, "dot"), similarity(a, b, "euclidean"),
        similarity(a, F.col("z")), similarity(a, F.col("s")),
    ).first()
    assert row[0] == pytest.approx(0.96) and row[1] == 24 and row[2] == pytest.approx(2**0.5)
    assert row[3] is None and row[4] is None
    with pytest.raises(ValueError):
        similarity(a, b, "manhattan")


def test_positions_of_very_many_matches(spark):
    import time

    def took(n):
        text = " ".join(f"u{i}@ex.org" for i in range(n))
        df = spark.createDataFrame([(text,)], "t string")
        begun = time.perf_counter()
        got = df.select(F.inline(pii.placed_findings(F.col("t"), ("email",)))).orderBy("ordinal").collect()
        seconds = time.perf_counter() - begun
        assert len(got) == n and all(text[r.position: r.position + len(r.value)] == r.value for r in got[:: max(1, n // 500)])
        assert [r.position for r in got[:300]] == [sum(len(f"u{j}@ex.org ") for j in range(i)) for i in range(300)]
        return seconds

    took(2_000)
    small, large = took(20_000), took(200_000)
    assert large < 40 * small + 5
