"""Enriching a stream by a small table that changes."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewater.operators.joins import enrich

# Fixed value: seconds between two reads of the dimension.
POLL_SECONDS = 3.0

log = logging.getLogger(__name__)


class Snapshot:
    """The whole dimension as last read.

    Each read replaces the one before, so entries deleted at the source disappear. A failing
    read keeps the last good one; without one it fails, and the micro-batch with it, so a
    restart reads its events again.
    Reads are written to ``folder``, which all executors must see, in two alternating
    places: tasks that run again find the rows they found before. One streaming query
    uses one snapshot.
    """

    def __init__(self, spark: SparkSession, read: Callable[[], DataFrame], schema: T.StructType, folder: str,
                 ttl_seconds: float = POLL_SECONDS, clock: Callable[[], float] = time.monotonic):
        self._spark, self._read, self._schema, self._folder = spark, read, schema, folder
        self._ttl, self._clock = ttl_seconds, clock
        self._reads = 0
        self._read_at: float | None = None
        self.rows = spark.createDataFrame([], schema)

    def refresh(self) -> Snapshot:
        """Read again when the last read is older than the time to live."""
        now = self._clock()
        if self._read_at is not None and now - self._read_at < self._ttl:
            return self
        place = f"{self._folder}/slot={self._reads % 2}"
        try:
            self._read().select(*self._schema.names).write.mode("overwrite").parquet(place)
        except Exception:
            if self._read_at is None:
                raise
            log.exception("dimension read failed; keeping the last good one")
            return self
        self.rows = self._spark.read.schema(self._schema).parquet(place)
        self._reads, self._read_at = self._reads + 1, now
        return self


def enrich_batches(snapshot: Snapshot, key: str, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A micro-batch handler: join with the current snapshot, then ``write``."""

    def handle(rows: DataFrame, batch_id: int) -> None:
        current = snapshot.refresh()
        write(enrich(rows, current.rows, key), batch_id)

    return handle
