"""Registry of queries: each has a Spark plan and, where SQL can say it, an oracle."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Query(NamedTuple):
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}

MODULES = ("text_queries", "running_queries", "window_queries", "join_queries", "routing_queries", "stream_queries")


def query(oracle: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` function under its own name."""

    def register(build):
        if build.__name__ in QUERIES:
            raise ValueError(f"query {build.__name__} is registered twice")
        QUERIES[build.__name__] = Query(build, oracle)
        return build

    return register


def load() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"tidewater.plans.{module}")
    return QUERIES
