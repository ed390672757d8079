"""Name -> query and its independent SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from worklens.queries.sql import BASE
from worklens.session import tune


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None):
    """Register a query; its SQL may use the shared table expressions of :mod:`.sql`."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        REGISTRY[name] = Query(run, None if sql is None else f"{BASE}\n{sql.strip()}")
        return function

    return register
