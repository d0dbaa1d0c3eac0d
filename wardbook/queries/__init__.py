"""The registered queries and their SQL counterparts."""

from wardbook.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
