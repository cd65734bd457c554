"""Named queries: Spark builders and their DuckDB oracles."""

from listenlens.plans.registry import NamedQuery, all_queries, register

__all__ = ["NamedQuery", "all_queries", "register"]
