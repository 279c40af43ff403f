"""Message topics: the records written and the producer settings.

Delivery is at least once. ``message_id`` is the same whenever a row is written again,
so readers can drop repeats.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.hashing import hash_partition
from tidewater.streaming.queries import writer

# Wait for all replicas, no duplicates from retries, five retries, keep order.
DELIVERY = {
    "kafka.acks": "-1",
    "kafka.enable.idempotence": "true",
    "kafka.retries": "5",
    "kafka.max.in.flight.requests.per.connection": "1",
}


def records(df: DataFrame, value: Column, key: Column | None = None, partitions: int | None = None,
            partition: int | None = None, identity: Sequence[str] = ()) -> DataFrame:
    """``value`` and, as asked, ``key``, ``partition`` and a ``message_id`` header.

    ``partitions`` chooses by key hash, ``partition`` sends everything to one place.
    """
    columns = [value.cast("string").alias("value")]
    if key is not None:
        columns.append(key.cast("string").alias("key"))
    if partitions is not None:
        if key is None or partition is not None:
            raise ValueError("a hashed partition needs a key and excludes a fixed partition")
        columns.append(hash_partition(key.cast("string"), partitions).cast("int").alias("partition"))
    elif partition is not None:
        columns.append(F.lit(partition).cast("int").alias("partition"))
    if identity:
        digest = F.sha2(F.to_json(F.struct(*identity)), 256).cast("binary")
        columns.append(F.array(F.struct(F.lit("message_id").alias("key"), digest.alias("value"))).alias("headers"))
    return df.select(*columns)


def producer_options(servers: str, topic: str, **overrides: str) -> dict[str, str]:
    """Sink options; override keys use ``__`` for dots, e.g. ``kafka__acks="1"``."""
    changed = {k.replace("__", "."): v for k, v in overrides.items()}
    return {"kafka.bootstrap.servers": servers, "topic": topic, **DELIVERY, **changed}


def send_stream(messages: DataFrame, options: dict[str, str], checkpoint: str, **query: str) -> StreamingQuery:
    out = writer(messages, checkpoint, **query).format("kafka").options(**options)
    return (out.option("includeHeaders", "true") if "headers" in messages.columns else out).start()


def send_batch(messages: DataFrame, options: dict[str, str]) -> None:
    messages.write.format("kafka").options(**options).save()
