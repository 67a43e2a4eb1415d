"""Where queries and the SQL that must give the same rows are written down."""

from __future__ import annotations

QUERIES = {}
ORACLE = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register
