"""Queries and the SQL that gives the same rows in another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Registers a function of (spark, sf_dir), by its name in the inventory."""

    def add(f):
        QUERIES[name] = f
        if oracle:
            from .views import expanded

            ORACLES[name] = expanded(oracle)
        return f

    return add
