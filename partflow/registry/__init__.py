"""Registered queries over the given tables, each with its SQL twin where there is one."""

from partflow.registry.base import Query, all_queries

__all__ = ["Query", "all_queries"]
