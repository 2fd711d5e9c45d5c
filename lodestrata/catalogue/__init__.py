"""Queries of the engine's operators over the input tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import content, diffs, imports, links, plans, search

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (diffs, plans, links, search, imports, content)


def queries() -> dict[str, Query]:
    return {f.__name__: f for m in MODULES for f in m.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
