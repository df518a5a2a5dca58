"""Registered queries: each key maps to a Spark callable (spark, sf_dir) and,
where the result is SQL-expressible, to an equivalent DuckDB SQL text over
the driver's views. Column names match between the two."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries (idempotent)."""
    from tessera.plans import queries_classify, queries_core, queries_prep, queries_stats  # noqa: F401
