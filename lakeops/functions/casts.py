"""Casts and ratios that do not raise under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_NUMBER_TEXT = (
    r"(?i)\A[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|inf|infinity|nan)\z"
)


def lenient_long(c: Column) -> Column:
    """Parse text to BIGINT; anything that is not exactly an integer becomes 0.

    The guard rejects what a Spark cast would tolerate: blanks before or after. Of a text
    that could be cast, its ends tell that, without a pattern.
    """
    parsed, digits = c.try_cast("bigint"), (ord("0"), ord("9"))
    tight = F.ascii(F.right(c, F.lit(1))).between(*digits) & (F.ascii(c).between(*digits) | F.ascii(c).isin(ord("+"), ord("-")))
    return F.when(parsed.isNotNull() & tight, parsed).otherwise(F.lit(0).cast("bigint"))


def lenient_double(c: Column) -> Column:
    """Parse text to DOUBLE; anything that is not exactly a number becomes 0.0.

    The guard also rejects Java-only spellings such as ``1d`` and ``2f``; it runs only on
    texts that could be cast.
    """
    parsed = c.try_cast("double")
    return F.when(parsed.isNotNull() & c.rlike(_NUMBER_TEXT), parsed).otherwise(F.lit(0.0))


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL where the denominator is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))
