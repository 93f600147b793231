"""Named queries: a Spark plan and, where SQL can say it, the same result as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.plans.views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a function of ``Views`` as a query."""

    def register(plan: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: plan(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return plan

    return register
