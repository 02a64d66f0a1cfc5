"""Registered queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from waitspark.registry import cleaning, features, models, statistics, tables

_MODULES = (tables, cleaning, features, statistics, models)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
