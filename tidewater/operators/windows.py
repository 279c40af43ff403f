"""Tumbling windows; every function serves batch tables and streams alike.

On a stream, call ``with_event_time`` first: a window is then emitted once the
watermark has passed its end, and rows for emitted windows are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.times import event_time_text
from tidewater.functions.text import join_fields

WINDOW = "window"


def with_event_time(df: DataFrame, time: str, delay: str) -> DataFrame:
    """Accept rows up to ``delay`` behind the newest one."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def with_ingest_time(df: DataFrame, name: str = "ingest_ts") -> DataFrame:
    """Stamp rows on arrival, for windows over processing time."""
    return with_event_time(df.withColumn(name, F.current_timestamp()), name, "0 seconds")


def tumbling(df: DataFrame, time: str, width: str, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Keys, window bounds as text and the aggregates."""
    grouped = df.groupBy(F.window(F.col(time), width).alias(WINDOW), *keys).agg(*aggregates)
    names = [c for c in grouped.columns if c not in (WINDOW, *keys)]
    return grouped.select(
        *keys,
        event_time_text(F.col("window.start")).alias("window_start"),
        event_time_text(F.col("window.end")).alias("window_end"),
        *names,
    )


def window_sum(df: DataFrame, time: str, width: str, key: str, value: Column, name: str = "total") -> DataFrame:
    return tumbling(df, time, width, [key], F.sum(value).cast("bigint").alias(name))


def window_max(df: DataFrame, time: str, width: str, key: str, value: Column, name: str = "max_value") -> DataFrame:
    return tumbling(df, time, width, [key], F.max(value).alias(name))


def window_count_sum(df: DataFrame, time: str, width: str, key: str, value: Column) -> DataFrame:
    return tumbling(
        df, time, width, [key], F.count(F.lit(1)).alias("count"), F.sum(value).cast("bigint").alias("sum")
    )


def page_views(df: DataFrame, time: str = "ts", width: str = "20 seconds", key: str = "eventType") -> DataFrame:
    """Rows per window and key, with the ``start,end,key,count`` line."""
    counted = tumbling(df, time, width, [key], F.count(F.lit(1)).alias("pv"))
    line = join_fields(",", F.col("window_start"), F.col("window_end"), F.col(key), F.col("pv"))
    return counted.withColumn("line", line)
