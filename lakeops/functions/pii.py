r"""Personal-data patterns and native detection expressions.

Detection runs inside Spark's own regex expressions (no Python UDF): one
``regexp_extract_all`` per pattern over the whole text.

The patterns are meant with ASCII word boundaries and Unicode blanks. Java 17
reads ``\b`` with Unicode letters and ``\s`` as ASCII blanks, so both are spelled
out here; with ``\b`` an address that follows an accented letter would be missed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The blanks that [\s] stands for, beside the ASCII ones.
WIDE_BLANKS = "\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}"
BLANKS = "\\t-\\r " + WIDE_BLANKS

# Detection patterns, in the order in which findings are reported.
PII_PATTERNS: dict[str, str] = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"(\+?1-?)?(\(?\d{3}\)?[\s.-]?)?\d{3}[\s.-]?\d{4}|\d{2,4}-\d{2,4}-\d{4}",
    "credit_card": r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "passport_jp": r"\b[A-Z]{2}\d{7}\b",
    "ip_address": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "postal_code_jp": r"\b\d{3}-\d{4}\b",
    "my_number": r"\b\d{4}\s?\d{4}\s?\d{4}\b",
}

# The ten-digit phone pattern used for in-text replacement.
INLINE_PHONE = r"(\+?1-?)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}"

# The patterns of the "contains no PII" check.
CHECKED_PATTERNS: dict[str, str] = {
    "email": PII_PATTERNS["email"],
    "phone": r"(\+?1-?)?(\(?\d{3}\)?[\s.-]?)?\d{3}[\s.-]?\d{4}",
    "ssn": PII_PATTERNS["ssn"],
    "credit_card": PII_PATTERNS["credit_card"],
}

# Name fragments that mark a column as sensitive.
SENSITIVE_NAME_FRAGMENTS = (
    "email", "mail", "e_mail",
    "phone", "tel", "telephone", "mobile",
    "name", "first_name", "last_name", "full_name",
    "ssn", "social_security",
    "address", "street", "city", "zip", "postal",
    "dob", "birth_date", "birthdate",
    "passport", "driver_license",
    "credit_card", "card_number",
    "ip_address", "ip",
    "password", "pwd",
)

# Suggested masking by the first fragment that the name contains.
SUGGESTED_MASKING = (
    ("email", "hash"),
    ("phone", "partial_mask"),
    ("name", "pseudonymize"),
    ("ssn", "full_mask"),
    ("passport", "full_mask"),
    ("address", "generalize"),
)

CONFIDENCE = 0.9

# A character without which a pattern cannot match; a plain search for it is far
# cheaper than the pattern.
_NEEDED = {"email": "@"}

# Every pattern needs an @, two digits in a row, or a digit before a full stop; one
# cheap scan lets a text without any of them skip all patterns.
_HINT = "@|[0-9][0-9.]"

_WORD = "[A-Za-z0-9_]"
_STARTS = f"(?<!{_WORD})"
_ENDS = f"(?!{_WORD})"
_ASCII_BOUNDARY = f"(?:(?={_WORD})(?<!{_WORD})|(?!{_WORD})(?<={_WORD}))"


def java_pattern(pattern: str) -> str:
    r"""``pattern`` for java.util.regex: ASCII ``\b``, Unicode ``\s``.

    Next to a token that can only be a word character, a boundary needs to look
    one way only; this keeps the scan of ordinary text cheap. ``\s`` may stand
    alone or inside a character class; the members are the same. A pattern that
    begins with an optional prefix gets its possible first characters in front.
    """
    first = "(?=[0-9+(])" if pattern.startswith(r"(\+?1-?)?") else ""
    out, in_class, i = [first], False, 0
    while i < len(pattern):
        two, rest = pattern[i : i + 2], pattern[i + 2 :]
        if two == r"\b":
            if re.match(r"\\d|\(\?:\\d|\[A-Z\]", rest):
                out.append(f"(?=[A-Z0-9]){_STARTS}")
            elif re.search(r"\\d(\{[0-9,]+\})?$", pattern[:i]):
                out.append(_ENDS)
            else:
                out.append(_ASCII_BOUNDARY)
        elif two == r"\s":
            out.append(BLANKS if in_class else f"[{BLANKS}]")
        elif two[0] == "\\":
            out.append(two)
        else:
            in_class = (in_class or two[0] == "[") and two[0] != "]"
            out.append(two[0])
            i -= 1
        i += 2
    return "".join(out)


def re2_pattern(pattern: str) -> str:
    r"""``pattern`` for RE2 engines, whose ``\b`` is ASCII already."""
    kept = pattern.replace(r"\b", "\x00")
    return java_pattern(kept).replace("\x00", r"\b").removeprefix("(?=[0-9+(])")


def has_hint(text: Column) -> Column:
    """False only if no pattern can match; NULL for NULL text."""
    return text.rlike(_HINT)


def _if_possible(text: Column, pii_type: str, then: Column, otherwise: Column) -> Column:
    needed = _NEEDED.get(pii_type)
    if needed is None:
        return then
    return F.when(~F.contains(text, F.lit(needed)), otherwise).otherwise(then)


def matches(text: Column, pii_type: str) -> Column:
    """All matches of one pattern, left to right: array<string>."""
    found = F.regexp_extract_all(text, F.lit(java_pattern(PII_PATTERNS[pii_type])), F.lit(0))
    return _if_possible(text, pii_type, found, F.array().cast("array<string>"))


def match_count(text: Column, pii_type: str) -> Column:
    count = F.regexp_count(text, F.lit(java_pattern(PII_PATTERNS[pii_type])))
    return _if_possible(text, pii_type, count, F.lit(0))


def occurs(text: Column, pii_type: str) -> Column:
    return _if_possible(text, pii_type, text.rlike(java_pattern(PII_PATTERNS[pii_type])), F.lit(False))


def findings(text: Column, types: tuple[str, ...] = tuple(PII_PATTERNS)) -> Column:
    """array<struct<type, ordinal, value>> over all patterns, overlaps kept.

    Ordered by pattern, then by place in the text. NULL text gives an empty array.
    """

    def labelled(pii_type: str) -> Column:
        return F.transform(
            matches(text, pii_type),
            lambda value, i: F.struct(
                F.lit(pii_type).alias("type"), i.cast("int").alias("ordinal"), value.alias("value")
            ),
        )

    empty = F.array().cast("array<struct<type:string,ordinal:int,value:string>>")
    return F.when(has_hint(text), F.concat(*map(labelled, types))).otherwise(empty)


_CHUNK = 256


def placed_findings(text: Column, types: tuple[str, ...] = tuple(PII_PATTERNS)) -> Column:
    """``findings`` with ``position``, the 0-based offset in characters.

    The pieces left between the matches give the offsets: match i starts after
    the pieces 0..i and the matches 0..i-1, a running sum in time in proportion to
    the matches.
    """

    def bound(value: Column, use: Callable[[Column], Column]) -> Column:
        # a one-element array binds a value, so that it is computed once
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def running(values: Column, base: Column, begin: Callable[[Column], Column], length: Callable[[Column], Column]) -> Column:
        """For each value where it begins: ``base``, the lengths before, and its own ``begin``."""
        return F.aggregate(
            values,
            F.struct(base.alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, v: F.struct(
                (acc["at"] + length(v)).alias("at"), F.concat(acc["out"], F.array(acc["at"] + begin(v))).alias("out")
            ),
            lambda acc: acc["out"],
        )

    def starts(found: Column, gaps: Column) -> Column:
        # An array that grows match by match is copied each time, so sums run inside
        # chunks of _CHUNK matches, and over the chunks.
        total = lambda s: s["g"] + s["m"]
        steps = F.zip_with(
            found, gaps, lambda m, g: F.struct(F.coalesce(F.length(m), F.lit(0)).alias("m"), F.length(g).alias("g"))
        )
        numbers = lambda st: F.sequence(F.lit(0), F.floor((F.size(st) - 1) / _CHUNK).cast("int"))
        chunks = bound(steps, lambda st: F.transform(numbers(st), lambda c: F.slice(st, c * _CHUNK + 1, F.lit(_CHUNK))))

        def placed_chunks(ch: Column) -> Column:
            sizes = F.transform(ch, lambda c: F.aggregate(c, F.lit(0), lambda n, s: n + total(s)))
            bases = running(sizes, F.lit(0), lambda _: F.lit(0), lambda n: n)
            return F.flatten(F.zip_with(ch, bases, lambda c, base: running(c, base, lambda s: s["g"], total)))

        return bound(chunks, placed_chunks)

    def placed(pii_type: str) -> Column:
        gaps = F.split(text, java_pattern(PII_PATTERNS[pii_type]), -1)

        def rows(once: Column) -> Column:
            return F.zip_with(
                F.transform(once["found"], lambda v, i: F.struct(v.alias("v"), i.cast("int").alias("i"))),
                F.slice(starts(once["found"], once["gaps"]), F.lit(1), F.size(once["found"])),
                lambda m, at: F.struct(
                    F.lit(pii_type).alias("type"), m["i"].alias("ordinal"), m["v"].alias("value"),
                    at.alias("position"),
                ),
            )

        # a one-element array binds matches and pieces, so that each is computed once
        both = F.array(F.struct(matches(text, pii_type).alias("found"), gaps.alias("gaps")))
        return F.when(occurs(text, pii_type), F.get(F.transform(both, rows), F.lit(0))).otherwise(empty)

    empty = F.array().cast("array<struct<type:string,ordinal:int,value:string,position:int>>")
    return F.when(has_hint(text), F.concat(*map(placed, types))).otherwise(empty)


def contains_pii(text: Column) -> Column:
    """True if any checked pattern occurs; NULL for NULL text."""
    hit = F.lit(False)
    for pii_type, pattern in CHECKED_PATTERNS.items():
        hit = hit | _if_possible(text, pii_type, text.rlike(java_pattern(pattern)), F.lit(False))
    return has_hint(text) & hit


def is_sensitive_name(name: str) -> bool:
    """Substring test on the lower-cased name; ``ip`` also hits "zip" and
    "description", which is kept because the rule is a plain substring rule."""
    lower = name.lower()
    return any(fragment in lower for fragment in SENSITIVE_NAME_FRAGMENTS)


def suggested_masking(name: str) -> str:
    lower = name.lower()
    return next((how for fragment, how in SUGGESTED_MASKING if fragment in lower), "none")
