"""Named queries and the SQL each one is compared with."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.tables import Tables

CATALOG = (
    "sources filters joins graph aggregates pivots windows islands sorting setops "
    "scalars documents changes quality temporal masking routines monitoring streams"
).split()


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


_QUERIES: dict[str, Query] = {}


def query(key: str, oracle: str | None = None):
    """Register a function of ``Tables`` under a key."""

    def register(build):
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")
        _QUERIES[key] = Query(key, build, oracle)
        return build

    return register


def all_queries() -> dict[str, Query]:
    for module in CATALOG:
        importlib.import_module(f"millrace.catalog.{module}")
    return dict(_QUERIES)
