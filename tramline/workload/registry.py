"""Registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tramline.session import prepare


class Tables:
    """The driver's tables of one scale, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._opened:
            # opening a table reads file footers: once per query is enough
            self._opened[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._opened[name]


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key!r} is registered twice")
        REGISTRY[key] = Query(key, build, sql)
        return build

    return register
