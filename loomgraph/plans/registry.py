"""Queries over the driver's tables, and the SQL that checks them."""

from __future__ import annotations

from . import graph_queries, text_queries, training_queries

_MODULES = (text_queries, graph_queries, training_queries)


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
