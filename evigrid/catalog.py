"""Registered queries of the engine and the SQL that each is compared with."""

from __future__ import annotations

from .plans import registered_records  # noqa: F401  registers its queries
from .plans.registered import QUERIES, SQL, flagship


def queries():
    """Queries by name."""
    return dict(QUERIES)


def oracle_sql():
    """SQL by query name."""
    return dict(SQL)


__all__ = ["flagship", "oracle_sql", "queries"]
