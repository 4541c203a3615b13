"""Registry of queries: a builder and, where SQL can say it, an equivalent DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

#: Last the one that writes tables of the others' queries.
MODULES = ("votes", "graphs", "spells", "relational", "entities", "texts", "frames")

BUILDERS: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder under a name, with its oracle."""

    def put(f: Builder) -> Builder:
        if name in BUILDERS:
            raise ValueError(f"{name} is registered twice")
        BUILDERS[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def queries() -> dict[str, Builder]:
    _load()
    return dict(BUILDERS)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)


def _load() -> None:
    """Modules register their queries as they are imported."""
    for name in MODULES:
        import_module(f"tallyframe.plans.{name}")
