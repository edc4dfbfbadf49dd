"""Expectations: declarations and their Spark form.

A *map* expectation is a predicate per value; NULL values are skipped except by
``not_null``. All map expectations of a suite are counted in one aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from lakeops.functions import pii

# Accepted spellings of column types.
TYPE_NAMES = {
    "INTEGER": "int", "INT": "int", "int32": "int", "IntegerType": "int",
    "BIGINT": "bigint", "int64": "bigint", "LongType": "bigint",
    "VARCHAR": "string", "STRING": "string", "StringType": "string",
    "DOUBLE": "double", "float64": "double", "DoubleType": "double",
    "BOOLEAN": "boolean", "bool": "boolean", "BooleanType": "boolean",
    "DATE": "date", "DateType": "date",
    "TIMESTAMP": "timestamp", "TimestampType": "timestamp",
}

# E-mail and Japanese postal code as whole values.
EMAIL_REGEX = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
POSTAL_CODE_REGEX = r"^\d{3}-\d{4}$"


@dataclass(frozen=True)
class Expectation:
    """One declared check; ``name`` selects its meaning, ``kwargs`` its limits."""

    name: str
    column: str | None = None
    kwargs: dict[str, Any] = field(default_factory=dict)
    mostly: float = 1.0


@dataclass(frozen=True)
class Suite:
    name: str
    expectations: Sequence[Expectation]


Predicate = Callable[..., Column]


def _between(c: Column, low=None, high=None) -> Column:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (c >= low)
    if high is not None:
        ok = ok & (c <= high)
    return ok


def _parseable(c: Column, formats: Sequence[str] = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).isNotNull()


# name -> predicate(column, **kwargs); true means the value is as expected
MAP_EXPECTATIONS: dict[str, Predicate] = {
    "not_null": lambda c: c.isNotNull(),
    "values_between": _between,
    "length_between": lambda c, low=None, high=None: _between(F.length(c), low, high),
    "matches_regex": lambda c, regex: c.rlike(regex),
    "in_set": lambda c, values: c.isin(list(values)),
    "not_empty_string": lambda c: F.trim(c) != "",
    "not_contains_pii": lambda c: ~pii.contains_pii(c.cast("string")),
    "postal_code": lambda c: c.rlike(POSTAL_CODE_REGEX),
    "dateutil_parseable": _parseable,
}

AGGREGATE_EXPECTATIONS = ("mean_between", "stdev_between")
TABLE_EXPECTATIONS = (
    "row_count_between", "columns_match_ordered_list", "columns_match_set", "column_exists",
    "type_in_list", "of_type",
)
SHUFFLE_EXPECTATIONS = ("unique", "median_between", "increasing")

# Declarative-suite spellings of the checks above.
SUITE_SPELLINGS = {
    "expect_table_row_count_to_be_between": "row_count_between",
    "expect_table_columns_to_match_ordered_list": "columns_match_ordered_list",
    "expect_table_columns_to_match_set": "columns_match_set",
    "expect_column_to_exist": "column_exists",
    "expect_column_values_to_not_be_null": "not_null",
    "expect_column_values_to_be_unique": "unique",
    "expect_column_values_to_be_in_type_list": "type_in_list",
    "expect_column_values_to_be_of_type": "of_type",
    "expect_column_value_lengths_to_be_between": "length_between",
    "expect_column_values_to_match_regex": "matches_regex",
    "expect_column_values_to_be_between": "values_between",
    "expect_column_values_to_be_in_set": "in_set",
    "expect_column_mean_to_be_between": "mean_between",
    "expect_column_median_to_be_between": "median_between",
    "expect_column_stdev_to_be_between": "stdev_between",
    "expect_column_values_to_be_dateutil_parseable": "dateutil_parseable",
    "expect_column_values_to_be_increasing": "increasing",
    "expect_column_values_to_not_contain_pii": "not_contains_pii",
    "expect_column_values_to_be_valid_postal_code": "postal_code",
}
_KWARG_SPELLINGS = {
    "min_value": "low", "max_value": "high", "value_set": "values", "column_list": "columns",
    "column_set": "columns", "type_list": "types", "type_": "type",
}


def register_expectation(name: str, predicate: Predicate) -> None:
    """Add a map expectation of one's own: ``predicate(column, **kwargs) -> Column``."""
    MAP_EXPECTATIONS[name] = predicate


def suite_from_config(config: dict[str, Any]) -> Suite:
    """Suite from its declarative form (a parsed JSON document)."""
    expectations = []
    for item in config["expectations"]:
        kwargs = {_KWARG_SPELLINGS.get(k, k): v for k, v in item.get("kwargs", {}).items()}
        kind = item["expectation_type"]
        expectations.append(
            Expectation(
                SUITE_SPELLINGS.get(kind, kind),
                kwargs.pop("column", None),
                mostly=kwargs.pop("mostly", 1.0),
                kwargs=kwargs,
            )
        )
    return Suite(config["expectation_suite_name"], expectations)


def is_expected(e: Expectation) -> Column:
    """True / false per row; NULL where the check skips the row."""
    c = F.col(e.column)
    ok = MAP_EXPECTATIONS[e.name](c, **e.kwargs)
    return ok if e.name == "not_null" else F.when(c.isNotNull(), ok)


def failing_rows(df: DataFrame, e: Expectation) -> DataFrame:
    """The rows a map or uniqueness check rejects, whole.

    For ``unique`` every member of a duplicate group fails; the duplicate keys
    are found by aggregation and joined back, so a hot key is not gathered.
    """
    if e.name == "unique":
        repeated = (
            df.filter(F.col(e.column).isNotNull())
            .groupBy(e.column)
            .agg(F.count("*").alias("_n"))
            .filter("_n > 1")
            .select(e.column)
        )
        return df.join(repeated, e.column, "left_semi").select(*df.columns)
    return df.filter(~is_expected(e))


def type_name(kind: DataType) -> str:
    """Type spelling used in results; both timestamp types count as TIMESTAMP."""
    name = kind.simpleString()
    return "timestamp" if name == "timestamp_ntz" else name


def accepted_type(kind: DataType, spelling: str) -> bool:
    return type_name(kind) == TYPE_NAMES.get(spelling, spelling.lower())
