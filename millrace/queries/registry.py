"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(fn: Callable) -> Callable:
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return add
