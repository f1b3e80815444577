"""Registered queries: every operator over the given tables, with the SQL that must agree."""

from voltmart.suite import (  # noqa: F401
    increment_queries, layers, mart_queries, quality_queries, rule_queries, stream_queries,
)
from voltmart.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
