"""The registered queries on the star-schema tables, each with its SQL check."""

from tillwise.workload import clickstream, columns, cleaning, jobs, joins, layouts, retail, tables  # noqa: F401
from tillwise.workload.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
