"""Query registration."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tickloom.plans.views import Tables, with_views


@dataclass(frozen=True)
class Query:
    name: str
    plan: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.plan(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, views: tuple[str, ...] = (), sql: str | None = None):
    def register(plan: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        REGISTRY[name] = Query(name, plan, with_views(views, sql) if sql else None)
        return plan

    return register
