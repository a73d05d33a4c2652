"""Registry of queries: a name, a callable over (spark, sf_dir), and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put
