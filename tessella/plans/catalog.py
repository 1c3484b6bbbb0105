"""Where query modules register what they have."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessella.plans.views import table, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(*inputs: str, sql: str | None = None):
    """Registers f(*DataFrames of the inputs) under its name."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*(table(spark, sf_dir, n) for n in inputs))
        if sql is not None:
            SQL[f.__name__] = with_views(sql)
        return f

    return add
