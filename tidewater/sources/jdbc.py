"""Database tables as dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the user table's columns.
USER_INFO_QUERY = "select userID,userName,userAge from user_info"


def jdbc_options(url: str, query: str = USER_INFO_QUERY, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    options = {"url": url, "query": query, "fetchsize": str(fetch_size)}
    options |= {k: v for k, v in {"user": user, "password": password, "driver": driver}.items() if v is not None}
    return options


def split_read(options: dict[str, str], column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Read a large table in parallel, by ranges of a numeric column."""
    changed = {k: v for k, v in options.items() if k != "query"}
    return changed | {"dbtable": f"({options['query']}) t", "partitionColumn": column, "lowerBound": str(lower),
                      "upperBound": str(upper), "numPartitions": str(partitions)}


def mysql_url(host: str, port: int, database: str) -> str:
    return f"jdbc:mysql://{host}:{port}/{database}?useUnicode=true&characterEncoding=UTF-8"


def options_from_properties(properties: dict[str, str]) -> dict[str, str]:
    url = mysql_url(properties["host"], int(properties["port"]), properties["database"])
    return jdbc_options(url, user=properties["username"], password=properties["password"])


def reader(spark: SparkSession, options: dict[str, str]) -> Callable[[], DataFrame]:
    """A function for ``Snapshot``: each call reads the table as it is then."""
    return lambda: spark.read.format("jdbc").options(**options).load()
