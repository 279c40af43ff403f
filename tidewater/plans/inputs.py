"""The driver's tables in the roles the jobs expect.

``event_type`` plays the behaviour (``purchase`` is a buy, ``view`` a browse), ``k``
in ``props`` the product number, ``customer`` the user table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.times import event_time_text

ORDER = ["ts", "event_id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def product_number() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the product number ``k``."""
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", product_number().alias("k"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ``userID, eventTime, eventType, productID`` records."""
    return numbered_events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("user_"), F.col("user_id")).alias("userID"),
        event_time_text(F.col("ts")).alias("eventTime"),
        F.col("event_type").alias("eventType"),
        F.col("k").cast("int").alias("productID"),
    )
