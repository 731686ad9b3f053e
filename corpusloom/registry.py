"""The queries by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register
