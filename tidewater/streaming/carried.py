"""Row-order results of a stream, one micro-batch at a time.

Each micro-batch is worked on by the batch operators, which cut hot keys into slices,
in event order and not in the order of arrival. What a key carries over - its total, its
open pair - is a row of a latest-value table that comes before the batch's rows. A
micro-batch that runs again reads what the batches before it left and so gives the same.

The processors keep their state in the state store instead: they answer sooner and need
no table, but handle all rows of a key that a micro-batch brings in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators import running
from tidewater.operators.changelog import changes_of
from tidewater.sinks.tables import LatestTable

Handler = Callable[[DataFrame, int], None]

CARRIED = "_carried"


def _with_carried(rows: DataFrame, table: LatestTable, batch_id: int) -> DataFrame:
    """The batch's rows and, with no order values and so before them, the rows their keys carry over."""
    fresh = rows.withColumn(CARRIED, F.lit(False))
    if batch_id == 0:
        return fresh
    before = table.read(rows.sparkSession, before=batch_id, among=rows)
    if "open" in before.columns:
        before = before.where("open").drop("open")
    return fresh.unionByName(before.withColumn(CARRIED, F.lit(True)), allowMissingColumns=True)


def _kept(joined: DataFrame, work: Handler, batch_id: int) -> None:
    """``work`` reads its rows several times: they are kept until it ends, also when it fails."""
    joined.persist()
    try:
        work(joined, batch_id)
    finally:
        joined.unpersist()


def running_sum_batches(state_path: str, keys: Sequence[str], order: Sequence[str], value: str, write: Handler,
                        name: str = "total", fold_every: int = 50, slices: int | None = None) -> Handler:
    """``write`` gets each batch's rows with the sum of ``value`` up to each of them."""
    table = LatestTable(state_path, keys, [], fold_every)

    def work(joined: DataFrame, batch_id: int) -> None:
        summed = running.running_sum(joined, keys, order, value, name, slices)
        write(summed.where(~F.col(CARRIED)).drop(CARRIED), batch_id)
        table.write_batch(joined.groupBy(*keys).agg(F.sum(value).alias(value)), batch_id)

    def handle(rows: DataFrame, batch_id: int) -> None:
        _kept(_with_carried(rows.withColumn(value, F.col(value).cast("bigint")), table, batch_id), work, batch_id)

    return handle


def running_count_batches(state_path: str, keys: Sequence[str], order: Sequence[str], write: Handler, name: str = "n",
                          fold_every: int = 50, slices: int | None = None) -> Handler:
    """``write`` gets each batch's rows with their position among all rows of their keys so far."""
    one = "one_row"
    summed = running_sum_batches(
        state_path, keys, order, one, lambda rows, batch_id: write(rows.drop(one), batch_id), name, fold_every, slices)
    return lambda rows, batch_id: summed(rows.withColumn(one, F.lit(1)), batch_id)


def count_changes_batches(state_path: str, keys: Sequence[str], order: Sequence[str], write: Handler,
                          fold_every: int = 50, slices: int | None = None) -> Handler:
    """``write`` gets the changes each batch makes to the count per key."""
    return running_count_batches(
        state_path, keys, order, lambda rows, batch_id: write(changes_of(rows, keys), batch_id), "n", fold_every, slices)


def pair_average_batches(state_path: str, keys: Sequence[str], order: Sequence[str], value: str, write: Handler,
                         fold_every: int = 50, slices: int | None = None) -> Handler:
    """``write`` gets the keys and whole-number means of the pairs each batch closes."""
    table = LatestTable(state_path, keys, [], fold_every)

    def work(joined: DataFrame, batch_id: int) -> None:
        means = running.pair_average(joined, keys, order, value, slices)
        write(means.select(*keys, "average"), batch_id)
        ends = joined.groupBy(*keys).agg(
            (F.count(F.lit(1)) % 2 == 1).alias("open"), F.max_by(value, F.struct(*order)).alias(value))
        table.write_batch(ends, batch_id)

    def handle(rows: DataFrame, batch_id: int) -> None:
        amounts = rows.select(*keys, *order, F.col(value).cast("bigint").alias(value))
        _kept(_with_carried(amounts, table, batch_id), work, batch_id)

    return handle
