"""Registered queries: every operator over the given tables, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geoledger.registry.views import standalone, view

Views = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function from a view lookup to a DataFrame, with its checking SQL."""

    def keep(build: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(lambda part: view(spark, sf_dir, part))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = standalone(sql)
        return build

    return keep


def load() -> None:
    """Import the modules that register queries."""
    from geoledger.registry import boundary, explore, files, match, quality, spatial, state  # noqa: F401
