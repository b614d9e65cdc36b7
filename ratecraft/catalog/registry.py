"""The list of named queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratecraft.catalog.oracle_views import with_views
from ratecraft.fixtures import Views, views

BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: str = ""):
    """Register ``build(views)`` under a name; ``uses`` lists the SQL views that ``sql`` selects from."""
    def register(build: Callable[[Views], DataFrame]):
        if name in BUILDERS:
            raise ValueError(f"two queries named {name}")
        BUILDERS[name] = lambda spark, folder: build(views(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(uses.split(), sql)
        return build
    return register
