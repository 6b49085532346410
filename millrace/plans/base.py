"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name, with the SQL that gives the same rows."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add
