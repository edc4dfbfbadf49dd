"""Operators bound to the shared test tables, each beside its oracle SQL."""

from lakeops.bindings.base import ORACLES, QUERIES
from lakeops.bindings import (  # noqa: F401  (registration)
    costs,
    marts,
    privacy,
    quality,
    relational,
    storage,
    streams,
    vectors,
)

__all__ = ["ORACLES", "QUERIES"]
