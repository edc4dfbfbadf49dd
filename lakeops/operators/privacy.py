"""Personal-data findings, masking policies, tokens and re-identification risk."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions import masks, pii
from lakeops.functions.timeparts import Moment, after, instant, moment

TOKEN_LIFETIME_DAYS = 90


def detect_pii(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], with_position: bool = False
) -> DataFrame:
    """Findings table: one row per match of any pattern in any column.

    ``keys, field, type, ordinal, value, confidence`` (and ``position``, the
    0-based character offset). ``ordinal`` numbers the matches of one type in
    one text from 0. Overlapping matches of different types are all kept.

    A row-wise projection: no shuffle, whatever the number of findings per row.
    """
    def in_field(c: str) -> Column:
        text = F.col(c).cast("string")
        rows = pii.placed_findings(text) if with_position else pii.findings(text)
        return F.transform(rows, lambda f: F.struct(F.lit(c).alias("field"), f.alias("f")))

    found = df.select(*keys, F.inline(F.concat(*map(in_field, columns))))
    return found.select(*keys, "field", "f.*", F.lit(pii.CONFIDENCE).alias("confidence"))


def sensitive_columns(df: DataFrame) -> DataFrame:
    """Columns of a schema with ``is_sensitive`` and ``suggested_masking``."""
    rows = [
        (f.name, f.dataType.simpleString(), pii.is_sensitive_name(f.name), pii.suggested_masking(f.name))
        for f in df.schema.fields
    ]
    return df.sparkSession.createDataFrame(
        rows, "name string, type string, is_sensitive boolean, suggested_masking string"
    )


def mask_fields(df: DataFrame, columns: Sequence[str] | None = None, salt: str = "") -> DataFrame:
    """Apply the whole-value policy to text columns (default: all of them)."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: masks.mask_whole_value(F.col(c), salt) for c in columns})


def mask_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace personal data inside texts."""
    return df.withColumns({c: masks.mask_inline(F.col(c)) for c in columns})


def users_masked(users: DataFrame, salt: str = "default") -> DataFrame:
    """The masked user model. An unknown age gives NULL, not the top band."""
    return users.select(
        "user_id",
        masks.mask_email(F.col("email")).alias("email_masked"),
        masks.mask_phone(F.col("phone")).alias("phone_masked"),
        masks.hash_pii_md5(F.col("email"), salt).alias("email_hashed"),
        "first_name",
        masks.initial(F.col("last_name")).alias("last_name_initial"),
        masks.generalize_age(F.col("age")).alias("age_range"),
        masks.generalize_zip(F.col("zip_code")).alias("zip_code_generalized"),
        "city",
        "country",
        "created_at",
    )


def tokenize(
    df: DataFrame, column: str, secret: str, issued_at: Moment
) -> tuple[DataFrame, DataFrame]:
    """Replace a column by tokens; returns ``(tokenized frame, vault)``.

    A token is a keyed digest of the value in UUID form: one token per distinct
    value, the same after a retry, and computed in place, so the frame needs no
    join with the vault. The vault holds ``token, value, expires_at`` once per value.
    Keep ``secret`` out of the data; without it tokens cannot be recomputed.
    """
    expires = instant(moment(issued_at) + dt.timedelta(days=TOKEN_LIFETIME_DAYS))
    vault = (
        df.select(F.col(column).cast("string").alias("value"))
        .filter("value IS NOT NULL")
        .distinct()
        .select(_token(F.col("value"), secret).alias("token"), "value", expires.alias("expires_at"))
    )
    return df.withColumn(column, _token(F.col(column).cast("string"), secret)), vault


def _token(value: Column, secret: str) -> Column:
    digest = F.sha2(F.concat(F.lit(secret), F.lit("\x1f"), value), 256)
    pieces = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(value.isNotNull(), F.concat_ws("-", *pieces))


def pii_daily_stats(findings: DataFrame, ts: str = "detected_at") -> DataFrame:
    """Per date and type: detections and distinct fields, newest date first."""
    return (
        findings.groupBy(F.to_date(ts).alias("date"), F.col("type").alias("pii_type"))
        .agg(F.count("*").alias("detections"), F.countDistinct("field").alias("affected_fields"))
        .orderBy(F.desc("date"), F.desc("detections"), "pii_type")
    )


def pii_audit_log(
    findings: DataFrame, resource: str, actor: str, method: str, run_at: Moment,
    compliance: Sequence[str] = ("GDPR", "CCPA"),
) -> DataFrame:
    """One audit row per run: masked fields, method and number of findings."""
    per_field = findings.groupBy("field").agg(F.count("*").alias("_n"))
    return per_field.agg(
        instant(run_at).alias("timestamp"),
        F.lit("pii_masking").alias("operation"),
        F.lit(actor).alias("user"),
        F.lit(resource).alias("resource"),
        F.array_join(F.array_sort(F.collect_set("field")), ",").alias("fields_masked"),
        F.lit(method).alias("masking_method"),
        F.lit(",".join(compliance)).alias("compliance"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("findings_count"),
    )


def pii_rate_alert(
    findings: DataFrame, as_of: Moment, threshold: int = 1000, hours: int = 1, ts: str = "detected_at"
) -> DataFrame:
    """One row: findings of the last hour and whether they exceed the threshold."""
    recent = findings.filter(after(findings, ts, moment(as_of) - dt.timedelta(hours=hours)))
    return recent.agg(F.count("*").alias("detections")).withColumn(
        "alert", F.col("detections") > threshold
    )


def k_anonymity(df: DataFrame, quasi_identifiers: Sequence[str], k: int) -> DataFrame:
    """Groups of equal quasi-identifiers with fewer than ``k`` rows, with their size."""
    return (
        df.groupBy(*quasi_identifiers).agg(F.count("*").alias("group_size")).filter(F.col("group_size") < k)
    )


def k_anonymity_summary(df: DataFrame, quasi_identifiers: Sequence[str], k: int) -> DataFrame:
    """One row: groups, groups below ``k``, rows in them, smallest group."""
    sizes = df.groupBy(*quasi_identifiers).agg(F.count("*").alias("_n"))
    small = F.col("_n") < k
    return sizes.agg(
        F.count("*").alias("groups"),
        F.count_if(small).alias("violating_groups"),
        F.coalesce(F.sum(F.when(small, F.col("_n"))), F.lit(0)).alias("violating_rows"),
        F.min("_n").alias("smallest_group"),
    )
