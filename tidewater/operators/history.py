"""A table that changes, joined as it was when each event happened.

Snapshots of the table become intervals: a row holds from the first snapshot that has it to the first that does not have
it so. Rows that stay the same through many snapshots are one interval, so what an event's key is compared with are its
changes, not all reads. A join by key and time then gives each event the row of its time; a row that was deleted by then
gives nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FROM, TO = "valid_from", "valid_to"


def snapshot(rows: DataFrame, moment) -> DataFrame:
    """``rows``, the whole table, as read at ``moment``."""
    return rows.withColumn(FROM, F.lit(moment).cast("timestamp"))


def intervals(snapshots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``snapshots``, each with ``valid_from`` and ``valid_to``, null while it still holds.

    Of repeated rows of a key in one snapshot one is taken. A snapshot that is empty leaves no trace, so a table that was
    emptied needs one with a null key. Rows with a null key only mark the moment.
    """
    values = [c for c in snapshots.columns if c not in (*keys, FROM)]
    # A row for each read; the next read ends what it gives.
    moments = snapshots.select(FROM).distinct().withColumn("_next", F.lead(FROM).over(Window.orderBy(FROM)))
    rows = snapshots.dropDuplicates([*keys, FROM]).join(moments, FROM)
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    by_key = Window.partitionBy(*keys).orderBy(FROM)
    now = F.struct(*values) if values else F.lit(True)
    same = F.lag("_next").over(by_key).eqNullSafe(F.col(FROM)) & F.lag(now).over(by_key).eqNullSafe(now)
    runs = rows.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(by_key))
    return runs.groupBy(*keys, "_run").agg(
        F.min(FROM).alias(FROM), F.max_by("_next", FROM).alias(TO), *[F.min_by(v, FROM).alias(v) for v in values]).drop("_run")


def enrich_as_of(events: DataFrame, history: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """``events`` with the values of ``history`` (from ``intervals``) at their ``time``; events without any are left out."""
    past = history.withColumnsRenamed({k: f"_{k}" for k in keys})
    holds = (F.col(time) >= F.col(FROM)) & (F.col(TO).isNull() | (F.col(time) < F.col(TO)))
    for key in keys:
        holds = holds & (F.col(key) == F.col(f"_{key}"))
    return events.join(past, holds).drop(FROM, TO, *[f"_{k}" for k in keys])


def enrich_as_of_batches(read: Callable[[], DataFrame], keys: Sequence[str], time: str,
                         write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A micro-batch handler: ``read`` gives the snapshots known by now, such as a folder that each read adds to.

    A repeated batch finds its rows again, as snapshots are only added.
    """

    def handle(rows: DataFrame, batch_id: int) -> None:
        write(enrich_as_of(rows, intervals(read(), keys), keys, time), batch_id)

    return handle
