"""All registered queries."""

from tidegate.plans import queries_columns, queries_feeds, queries_files, queries_relational  # noqa: F401
from tidegate.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
