"""A table polled as a stream: every so many seconds the whole table, read by key ranges in parallel.

An offset is the number of a read, counted by the clock in steps of the interval, so that a query started again goes on
behind the last read its checkpoint has. A micro-batch holds one read, the newest: a table that changes can't be read as
it was, so reads that were missed stay out, and a repeated batch has its read's number but the rows there are by then.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: seconds between two reads.
POLL_SECONDS = 3.0
READ_NUMBER = "read_number"

#: Gives the rows whose key is from the first bound on and below the second; null bounds are open.
ReadRange = Callable[[object, object], Iterator[tuple]]


class KeyRange(InputPartition):
    def __init__(self, low, high, number: int):
        self.low, self.high, self.number = low, high, number


class PolledReader(DataSourceStreamReader):
    def __init__(self, read: ReadRange, bounds: Sequence, seconds: float):
        self.read_range, self.bounds, self.seconds = read, list(bounds), seconds

    def initialOffset(self) -> dict:
        return {"read": 0}

    def latestOffset(self) -> dict:
        return {"read": int(time.time() // self.seconds)}

    def partitions(self, start: dict, end: dict) -> list[KeyRange]:
        if end["read"] <= start["read"]:
            return []
        return [KeyRange(low, high, end["read"]) for low, high in zip([None, *self.bounds], [*self.bounds, None], strict=True)]

    def read(self, partition: KeyRange) -> Iterator[tuple]:
        for row in self.read_range(partition.low, partition.high):
            yield (*row, partition.number)


def polled_table(name: str, schema: str, read: ReadRange, bounds: Sequence = (), seconds: float = POLL_SECONDS) -> type[DataSource]:
    """A format to register with ``spark.dataSource.register`` and to read with ``spark.readStream.format(name)``.

    ``schema`` is the DDL of what ``read`` gives; ``read_number`` is added. ``bounds`` are ascending keys: each range
    between two of them, and what lies outside, is one task. ``read`` opens its own connection, in the task.
    """

    class PolledTable(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return f"{schema}, {READ_NUMBER} bigint"

        def streamReader(self, schema) -> PolledReader:
            return PolledReader(read, bounds, seconds)

    return PolledTable
