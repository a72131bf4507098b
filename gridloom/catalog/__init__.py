"""Named queries over the star-schema test tables, each with its SQL equivalent."""

from __future__ import annotations

from gridloom.catalog.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
