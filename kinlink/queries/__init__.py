"""The registered queries of the linkage operators, and their SQL."""

from .linkage import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
