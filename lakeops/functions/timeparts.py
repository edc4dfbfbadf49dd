"""Time predicates written against literals, so that they reach the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

Moment = dt.datetime | dt.date | str


def moment(value: Moment) -> dt.datetime:
    """A naive datetime from a datetime, a date or ISO text; with an offset, in UTC."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return value if value.tzinfo is None else value.astimezone(dt.timezone.utc).replace(tzinfo=None)


def instant(value: Moment) -> Column:
    """TIMESTAMP_NTZ literal.

    The value is fixed on the driver: a plan never calls ``now()``, so that a
    retried task sees the same instant and Parquet can skip row groups on it.
    """
    return F.lit(moment(value).isoformat(sep=" ")).cast("timestamp_ntz")


def _typed(df: DataFrame, column: str, value: dt.datetime) -> Column:
    """``value`` as a literal of the column's own type.

    A literal of another type would put a cast around the column, and the
    predicate would no longer reach Parquet.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, DateType):
        days = value.date()
        if value.time() != dt.time():  # a date is its midnight: round up
            days += dt.timedelta(days=1)
        return F.lit(days.isoformat()).cast(kind)
    if not isinstance(kind, (TimestampType, TimestampNTZType)):
        raise TypeError(f"{column} is {kind.simpleString()}, not a date or timestamp")
    return F.lit(value.isoformat(sep=" ")).cast(kind)


def not_before(df: DataFrame, column: str, start: Moment) -> Column:
    return F.col(column) >= _typed(df, column, moment(start))


def before(df: DataFrame, column: str, end: Moment) -> Column:
    return F.col(column) < _typed(df, column, moment(end))


def after(df: DataFrame, column: str, start: Moment) -> Column:
    """Strictly later than ``start``; a date counts as its midnight."""
    start = moment(start)
    if isinstance(df.schema[column].dataType, DateType):
        start = dt.datetime(start.year, start.month, start.day)
    return F.col(column) > _typed(df, column, start)


def since(df: DataFrame, column: str, as_of: Moment, **window: float) -> Column:
    """``column >= as_of - window``; window as in ``datetime.timedelta``."""
    return not_before(df, column, moment(as_of) - dt.timedelta(**window))


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed between two timestamps (DATEDIFF('second', ...))."""
    whole = lambda c: F.unix_timestamp(F.date_trunc("second", c.cast("timestamp")))
    return whole(end) - whole(start)


def day(ts: Column) -> Column:
    return F.to_date(ts)


def month(ts: Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(F.to_date(ts), "month")


def months_before(value: dt.date, months: int) -> dt.date:
    """Same day ``months`` earlier, clipped to the end of a shorter month."""
    index = value.year * 12 + value.month - 1 - months
    year, m = divmod(index, 12)
    last = (dt.date(year + (m == 11), (m + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(year, m + 1, min(value.day, last))
