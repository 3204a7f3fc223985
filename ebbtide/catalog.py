"""All queries of the engine itself, and the SQL they are checked against."""

from __future__ import annotations

from ebbtide.queries import build, screens, stores, texts

_MODULES = (build, screens, stores, texts)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
