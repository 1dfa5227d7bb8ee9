"""Registered queries with their DuckDB counterparts."""

from folioworks.queries import articles, domain, pages, relations, scans, whole  # noqa: F401
from folioworks.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
