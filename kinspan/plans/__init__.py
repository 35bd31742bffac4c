"""Registered queries over the given tables, each with its SQL twin where one exists."""

from kinspan.plans import cell_queries, file_queries, graph_queries, relation_queries, table_queries
from kinspan.plans.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "cell_queries",
    "file_queries",
    "graph_queries",
    "relation_queries",
    "table_queries",
]
