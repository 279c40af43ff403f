"""Starting a query anew with another number of state stores, without losing what it has kept.

The number of stores is part of a checkpoint. So a query that has to grow is stopped, its state read from its checkpoint,
and another query started with that as its first state, in a checkpoint of its own, from the place in the input
the old one had come to. The state goes from store to store by a shuffle; nothing of it passes through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.streaming.queries import published_state


def kept_state(spark: SparkSession, checkpoint: str, variable: str, items: str | None = None) -> DataFrame:
    """The keys and values of a processor's state ``variable`` as of the last finished micro-batch.

    A map has a row for each of its items; ``items`` names the column of their keys. Of a query that keeps its keys in
    parts, the keys are text.
    """
    state = published_state(spark, checkpoint, variable)
    if "list_element" in state.columns:
        return state.select("list_element.*")
    if items is None:
        return state.select("key.*", "value.*")
    item = F.col("user_map_key").getField(state.schema["user_map_key"].dataType.names[0])
    return state.select("key.*", item.alias(items), "user_map_value.*")


def input_position(query: StreamingQuery, source: int = 0) -> str | None:
    """Where a query has come to in an input: its source's offset behind the last micro-batch, None before the first."""
    progress = query.lastProgress
    return None if progress is None else progress["sources"][source]["endOffset"]


def topic_from(options: Mapping[str, str], position: str | None) -> dict[str, str]:
    """Reader options of a topic that go on at an ``input_position``."""
    return dict(options) if position is None else {**options, "startingOffsets": position}
