"""Queries over the test tables and the SQL statements they are checked against."""

from registry.base import ORACLE, QUERIES
from registry import basics, facts, inbound, measures, rates, relational, reports, stored  # noqa: F401  registers the queries

__all__ = ["ORACLE", "QUERIES"]
