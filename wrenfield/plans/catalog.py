"""Registration of queries: ``@query(name, sql)`` over functions of ``Views``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            SQL[name] = with_views(sql)
        return f

    return register
