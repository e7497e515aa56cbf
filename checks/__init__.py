"""Checks of the library on the given tables, each beside its SQL."""

from checks import arrivals, files, marts, operators, tables  # noqa: F401  (they register their queries)
from checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
