"""Registered checks: each key has a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where SQL can express it, an equivalent DuckDB statement over the same
tables. Every callable reads the given tables (or data Spark derives from
them), so its work grows with the tables."""

from __future__ import annotations

REGISTRY: dict = {}


def case(name: str, sql: str | None = None):
    """Register a Spark callable under ``name`` with its oracle SQL."""
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


MODULES = ["curation", "runbooks", "landing", "incremental", "aggregates", "reshaping", "explore",
           "scalars", "streams"]


def load_all():
    import importlib
    for m in MODULES:
        try:
            importlib.import_module(f"sluice.suite.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"sluice.suite.{m}":
                raise
    return REGISTRY
