"""Message topics. The connector is a Spark package and must be on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Reset policies of a topic reader and the starting offsets they mean; ``none`` must find a checkpoint.
STARTING_OFFSETS = {"earliest": "earliest", "latest": "latest"}


def consumer_options(servers: str, topic: str | None = None, pattern: str | None = None, reset: str = "latest",
                     group_prefix: str | None = None, most_per_batch: int | None = None) -> dict[str, str]:
    """Reader options for one topic or for all topics matching a pattern.

    New topics and partitions are found while the query runs. Offsets live in the query's
    checkpoint; ``reset`` only matters for the first start.
    """
    if (topic is None) == (pattern is None):
        raise ValueError("give a topic or a pattern")
    if reset not in STARTING_OFFSETS:
        raise ValueError(f"reset must be one of {sorted(STARTING_OFFSETS)}")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": STARTING_OFFSETS[reset]}
    options |= {"subscribe": topic} if topic else {"subscribePattern": pattern}
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    if most_per_batch:
        options["maxOffsetsPerTrigger"] = str(most_per_batch)
    return options


def options_from_properties(properties: dict[str, str], topic_key: str = "topic_name") -> dict[str, str]:
    """Reader options from the job's properties file."""
    return consumer_options(
        properties["bootstrap.servers"], topic=properties[topic_key],
        reset=properties.get("auto.offset.reset", "latest"), group_prefix=properties.get("group.id"))


def message_values(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """``value``: message bodies as text."""
    return spark.readStream.format("kafka").options(**options).load().selectExpr("CAST(value AS STRING) AS value")


#: Where a message is in its topic: an order that stays as it is when a micro-batch is repeated.
PLACE = ("topic", "partition", "offset")


def message_rows(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """``value`` and the message's place."""
    return spark.readStream.format("kafka").options(**options).load().selectExpr("CAST(value AS STRING) AS value", *PLACE)
