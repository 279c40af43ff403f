"""Literal rows and files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame(list(rows), schema)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the lines of the files there now."""
    return spark.read.text(path)


def watch_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """``value``: the lines of files as they appear in a folder.

    A file is read once: add files, do not append to them.
    """
    reader = spark.readStream.format("text")
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def watch_table(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as they appear; the schema is that of the files there now."""
    reader = spark.readStream.format("parquet").schema(spark.read.parquet(path).schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


# Where a text socket is looked for unless told otherwise.
SOCKET_HOST, SOCKET_PORT = "localhost", 6789


def socket_lines(spark: SparkSession, host: str = SOCKET_HOST, port: int = SOCKET_PORT) -> DataFrame:
    """Lines of a text socket. For trying things out: a socket cannot be read again after a failure."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
