"""Text and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form of an event time.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_event_time(text: Column) -> Column:
    """Timestamp of a ``yyyy-MM-dd HH:mm:ss`` text; null for anything else."""
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT))


def event_time_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, fractions cut off.

    Goes through the string cast so that zone-less timestamps stay zone-less.
    """
    return F.substring(ts.cast("string"), 1, 19)


def millis_to_timestamp(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def load_time() -> Column:
    """One stamp per query or micro-batch."""
    return F.current_timestamp()
