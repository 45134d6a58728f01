"""Query registry: ``queries()`` callables and their oracle SQL, registered side by side."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap
