"""Finite streams that end: what is still open when the input ends comes out.

A window waits for a watermark behind its end, and a stream that stops has no later row to move it. So an input that may
end carries a second source of its own, a folder of markers. A marker is a row at the end of time: it moves the watermark
behind every window and is never a row of the result. Writing it is what ends the stream, once and for good; rows that
come later are late.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.streaming.queries import finish

#: The time of a marker. Rows at or after it are left out.
END_OF_TIME = datetime(9000, 1, 1)
MARKERS = "ends_at timestamp"
NOT_BELOW = "_not_below"


class Ending:
    """The markers of one query, in ``folder``, which all executors see.

    Every watermarked input of the query goes through ``timed``: the slowest input holds a watermark back.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        # A file source wants its folder to be there; a restart finds it with what it holds.
        self._write([], "ignore")

    def _write(self, rows: list[tuple[datetime]], mode: str) -> None:
        self.spark.createDataFrame(rows, MARKERS).coalesce(1).write.mode(mode).parquet(self.folder)

    def timed(self, stream: DataFrame, time: str, delay: str) -> DataFrame:
        """``stream`` with a watermark ``delay`` behind its newest ``time``, and behind all of them when it has ended.

        Filters that are to reach the source belong before this: those behind it stay behind it.
        """
        markers = self.spark.readStream.schema(MARKERS).parquet(self.folder)
        stamped = stream.withColumn(time, F.col(time).cast("timestamp"))
        row = [F.lit(END_OF_TIME).cast("timestamp").alias(f.name) if f.name == time
               else F.lit(None).cast(f.dataType).alias(f.name) for f in stamped.schema.fields]
        both = stamped.union(markers.where(F.col("ends_at").isNotNull()).select(*row)).withWatermark(time, delay)
        # Later filters must not take the markers away before the watermark has seen them. The optimizer moves filters below
        # a watermark, but none below a random number, and this one is used.
        return both.withColumn(NOT_BELOW, F.rand(0)).where(
            (F.col(time) < F.lit(END_OF_TIME)) & (F.col(NOT_BELOW) >= 0)).drop(NOT_BELOW)

    def ended(self) -> bool:
        return not self.spark.read.schema(MARKERS).parquet(self.folder).isEmpty()

    def end(self) -> None:
        """The input is complete."""
        if not self.ended():
            self._write([(END_OF_TIME,)], "append")

    def run(self, start: Callable[[], StreamingQuery]) -> StreamingQuery:
        """Read what is there, end the stream, and bring out what was open.

        ``start`` starts the query, the second time from its checkpoint. Run again after a failure at any point, it goes on
        where it stopped.
        """
        if not self.ended():
            finish(start())
            self.end()
        return finish(start())
