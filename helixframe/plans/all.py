"""Every registered query and its SQL."""

from . import enrichment, groups, layers, profiles, relational, statistics, vector_queries  # noqa: F401  they register their queries
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
