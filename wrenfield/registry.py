"""All queries over the event-curation operators and their DuckDB counterparts, by name."""

from __future__ import annotations

from .plans import linkage, projections, publish, reports, review, rules, travel  # noqa: F401
from .plans.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
