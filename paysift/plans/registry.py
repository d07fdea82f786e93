"""The registry of queries and access to the tables they read."""

from __future__ import annotations

import importlib
import textwrap
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

MODULES = ["cleaning", "checks", "joining", "starschema", "summaries", "ranking", "vocabularies", "mining", "networks", "splitting",
           "classifying", "grouping", "publishing", "storing"]
TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations"]


class Tables:
    """The given tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = prepare(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    """A named query, the capabilities it covers and its SQL equivalent (if SQL can express it)."""

    name: str
    covers: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable:
    """Register a function of `Tables` under its own name."""
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = build.__name__
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, covers, build, textwrap.dedent(sql).strip() if sql else None)
        return build
    return register


def load_all() -> dict[str, Query]:
    """Import every plan module and return the registry."""
    for module in MODULES:
        importlib.import_module(f"{__package__}.{module}")
    return REGISTRY
