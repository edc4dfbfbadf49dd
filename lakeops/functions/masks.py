"""Masking functions, Column -> Column. NULL stays NULL unless stated otherwise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lakeops.functions import pii

REDACTED = "***REDACTED***"

# A whole value that is an e-mail address.
EMAIL_VALUE = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

# In-text replacements. The order keeps a card number or SSN from
# being eaten by the phone pattern.
INLINE_REPLACEMENTS = (
    ("credit_card", pii.PII_PATTERNS["credit_card"], "****-****-****-****"),
    ("ssn", pii.PII_PATTERNS["ssn"], "***-**-****"),
    ("email", pii.PII_PATTERNS["email"], "***@***.com"),
    ("phone", pii.INLINE_PHONE, "***-***-****"),
)

# Whole-value policy; types not listed keep three characters.
WHOLE_VALUE_POLICY = {
    "email": "hash",
    "phone": "keep4",
    "credit_card": "keep4",
    "ssn": "redact",
    "passport_jp": "redact",
}

# Upper age bounds (exclusive) and their bands.
AGE_BANDS = ((18, "0-17"), (30, "18-29"), (50, "30-49"), (65, "50-64"))
TOP_AGE_BAND = "65+"


def hash_pii(c: Column, salt: str = "") -> Column:
    """Hex SHA-256 of value followed by salt."""
    return F.sha2(F.concat(c, F.lit(salt)), 256)


def hash_pii_md5(c: Column, salt: str = "default_salt") -> Column:
    """Hex MD5 of value followed by salt; NULL hashes as the salt alone."""
    return F.md5(F.concat_ws("", c, F.lit(salt)))


def partial_mask(c: Column, start: int = 0, end: int = 4) -> Column:
    """Keep ``start`` leading and ``end`` trailing characters, star the rest.

    Values too short to hide anything are starred whole. Length is preserved.
    """
    n = F.length(c)
    shown_head = F.substring(c, 1, start) if start else F.lit("")
    shown_tail = F.right(c, F.lit(end)) if end else F.lit("")
    stars = F.repeat(F.lit("*"), n - F.lit(start + end))
    return F.when(n <= start + end, F.repeat(F.lit("*"), n)).otherwise(
        F.concat(shown_head, stars, shown_tail)
    )


def mask_email(c: Column) -> Column:
    """First two characters of the local part, then ``***@`` and the domain.

    Values that are not addresses pass through unchanged.
    """
    local, domain = (F.split_part(c, F.lit("@"), F.lit(i)) for i in (1, 2))
    masked = F.concat(F.left(local, F.lit(2)), F.lit("***@"), domain)
    return F.when(c.rlike(EMAIL_VALUE.replace("$", r"\z")), masked).otherwise(c)


def mask_phone(c: Column) -> Column:
    """``***-***-`` and the last four characters."""
    return F.concat(F.lit("***-***-"), F.right(c, F.lit(4)))


def redact(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit(REDACTED))


def generalize_age(c: Column) -> Column:
    """Age band. An unknown age stays NULL instead of falling into the top band."""
    band = F.when(c.isNull(), F.lit(None).cast("string"))
    for bound, label in AGE_BANDS:
        band = band.when(c < bound, F.lit(label))
    return band.otherwise(F.lit(TOP_AGE_BAND))


def generalize_zip(c: Column) -> Column:
    return F.concat(F.left(c, F.lit(3)), F.lit("****"))


def generalize_date(c: Column, granularity: str = "month") -> Column:
    """``yyyy`` or ``yyyy-MM``; any other granularity returns the date as text."""
    formats = {"year": "yyyy", "month": "yyyy-MM"}
    if granularity not in formats:
        return c.cast("string")
    return F.date_format(c, formats[granularity])


def initial(c: Column) -> Column:
    """First letter and a full stop."""
    return F.concat(F.left(c, F.lit(1)), F.lit("."))


def mask_inline(c: Column) -> Column:
    """Replace card numbers, SSNs, addresses and phone numbers inside a text."""
    out = c
    for _, pattern, replacement in INLINE_REPLACEMENTS:
        out = F.regexp_replace(out, F.lit(pii.java_pattern(pattern)), F.lit(replacement))
    return F.when(pii.has_hint(c), out).otherwise(c)


def mask_whole_value(c: Column, salt: str = "") -> Column:
    """Mask a whole value according to what is found in it.

    The policy applies once per finding, in pattern order, to the value as
    masked so far: an address hashes it (two addresses hash it twice), a phone
    or card number keeps four characters, an SSN or passport redacts it, and
    anything else keeps three characters. Findings come from the original value.

    The findings become a short array of steps that one fold applies. Only the
    hash changes when repeated, so every other step appears at most once.
    """
    steps = [F.array_repeat(F.lit("hash"), pii.match_count(c, "email"))]
    for pii_type in pii.PII_PATTERNS:
        if pii_type != "email":
            step = F.array(F.lit(WHOLE_VALUE_POLICY.get(pii_type, "keep3")))
            steps.append(F.when(pii.occurs(c, pii_type), step).otherwise(F.array().cast("array<string>")))

    def apply(acc: Column, step: Column) -> Column:
        return (
            F.when(step == "hash", hash_pii(acc, salt))
            .when(step == "keep4", partial_mask(acc, 0, 4))
            .when(step == "redact", F.lit(REDACTED))
            .otherwise(partial_mask(acc, 0, 3))
        )

    return F.when(pii.has_hint(c), F.aggregate(F.concat(*steps), c, apply)).otherwise(c)
