"""Starting streaming queries.

Every sink needs a checkpoint folder: without one a restart would lose or repeat rows.
A query continues from its checkpoint, and the folder stays when the query stops.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Fixed value: how often a monitored folder is listed again.
DIRECTORY_SCAN = "12 seconds"


def writer(df: DataFrame, checkpoint: str, name: str | None = None, mode: str = "append",
           every: str | None = None) -> DataStreamWriter:
    """``every`` is a trigger interval; by default the available input is read and the query ends."""
    if not checkpoint:
        raise ValueError("a streaming sink needs a checkpoint location")
    out = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        out = out.queryName(name)
    return out.trigger(processingTime=every) if every else out.trigger(availableNow=True)


def to_files(df: DataFrame, path: str, checkpoint: str, format: str = "parquet",
             partition_by: Sequence[str] = (), **options: str) -> StreamingQuery:
    """Exactly-once files: only committed files are read back by Spark."""
    out = writer(df, checkpoint, **options).format(format).option("path", path)
    return (out.partitionBy(*partition_by) if partition_by else out).start()


def to_console(df: DataFrame, checkpoint: str, rows: int = 20, **options: str) -> StreamingQuery:
    """A look at the first ``rows`` of each micro-batch; not a sink for results."""
    shown = writer(df, checkpoint, **options).format("console")
    return shown.option("numRows", rows).option("truncate", "false").start()


def to_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, **options: str) -> StreamingQuery:
    """``handle(rows, batch_id)`` per micro-batch; it must give the same result when a batch is repeated."""
    return writer(df, checkpoint, **options).foreachBatch(handle).start()


@contextmanager
def state_partitions(spark: SparkSession, number: int) -> Iterator[None]:
    """Queries first started inside keep their state in ``number`` parts, for good.

    A query takes the session's settings when it starts, so they can be put back then.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(number))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait, as long as it takes, for a query that ends by itself."""
    query.awaitTermination()
    return query


def published_state(spark: SparkSession, checkpoint: str, variable: str | None = None, operator: int = 0) -> DataFrame:
    """What a query keeps per key, as of its last finished micro-batch, readable from outside.

    ``variable`` names a processor's state; aggregates have only one and need no name.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    return (reader.option("stateVarName", variable) if variable else reader).load(checkpoint)
