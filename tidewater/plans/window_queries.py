"""Tumbling-window aggregates."""

from pyspark.sql import functions as F

from tidewater.functions.text import split_on
from tidewater.operators import windows
from tidewater.plans.catalogue import query
from tidewater.plans.inputs import numbered_events, table


def bounds_oracle(width: str) -> str:
    """Window bounds of ``ts`` as text, in DuckDB."""
    start = f"time_bucket(INTERVAL {width}, ts)"
    return (f"strftime({start}, '%Y-%m-%d %H:%M:%S') AS window_start, "
            f"strftime({start} + INTERVAL {width}, '%Y-%m-%d %H:%M:%S') AS window_end")


@query(f"""
    SELECT word, {bounds_oracle('1 HOUR')}, count(*)::BIGINT AS total
    FROM (SELECT ts, unnest([event_type, props->>'k']) AS word FROM events) GROUP BY ALL
""")
def window_word_sum(spark, sf_dir):
    lines = numbered_events(spark, sf_dir).select("ts", F.concat_ws(",", "event_type", "k").alias("value"))
    pairs = lines.select("ts", F.explode(split_on(F.col("value"), ",")).alias("word"))
    return windows.window_sum(pairs, "ts", "1 hour", "word", F.lit(1))


@query(f"""
    SELECT event_type, {bounds_oracle('1 HOUR')}, max((props->>'k')::BIGINT) AS max_value FROM events GROUP BY ALL
""")
def window_max(spark, sf_dir):
    return windows.window_max(numbered_events(spark, sf_dir), "ts", "1 hour", "event_type", F.col("k"))


@query(f"""
    SELECT event_type, {bounds_oracle('1 HOUR')}, count(*)::BIGINT AS "count", sum((props->>'k')::BIGINT)::BIGINT AS "sum"
    FROM events GROUP BY ALL
""")
def window_count_sum(spark, sf_dir):
    return windows.window_count_sum(numbered_events(spark, sf_dir), "ts", "1 hour", "event_type", F.col("k"))


def pv_oracle(width: str, closed_only: str = "") -> str:
    return f"""
        WITH counted AS (SELECT event_type, {bounds_oracle(width)}, count(*)::BIGINT AS pv FROM events GROUP BY ALL)
        SELECT *, window_start || ',' || window_end || ',' || event_type || ',' || pv AS line FROM counted {closed_only}
    """


@query(pv_oracle("1 HOUR"))
def pv_tumbling(spark, sf_dir):
    return windows.page_views(table(spark, sf_dir, "events"), "ts", "1 hour", "event_type")


@query(pv_oracle("20 SECOND"))
def pv_tumbling_20s(spark, sf_dir):
    return windows.page_views(table(spark, sf_dir, "events"), "ts", "20 seconds", "event_type")
