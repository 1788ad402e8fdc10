"""Queries by name, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
