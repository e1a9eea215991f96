"""Registration of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from partflow.registry.fixtures import FIXTURES, Inputs, for_duckdb, with_views
from partflow.registry.twins import TWIN_VIEWS

FAMILIES = ("scalars", "demand", "state", "quality", "forecast", "supersession", "calendar",
            "reports", "operators", "files", "evidence")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Inputs], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Inputs(spark, folder))

    def twin(self) -> str | None:
        return self.sql and for_duckdb(with_views(self.sql, {**FIXTURES, **TWIN_VIEWS}))


class Family(dict):
    """Queries of one module, filled by decorator."""

    def query(self, sql: str | None = None, name: str | None = None):
        def register(build: Callable[[Inputs], DataFrame]):
            key = name or build.__name__
            self[key] = Query(key, build, sql)
            return build
        return register


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for family in FAMILIES:
        found.update(import_module(f"partflow.registry.{family}").QUERIES)
    return found
