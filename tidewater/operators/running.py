"""Results that depend on the rows before, one output per input row.

Batch forms. Their stream twins, which keep per-key state, are in
``tidewater.streaming.processors``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import whole_mean
from tidewater.operators.slices import slice_rows


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "n",
                  slices: int | None = None, same_rows: DataFrame | None = None) -> DataFrame:
    """Position of the row among its key's rows; ``same_rows`` as in ``slice_rows``."""
    cut = slice_rows(df, list(keys), list(order), slices, same_rows).carry(_before=(F.count(F.lit(1)), "sum"))
    here = F.row_number().over(cut.window).cast("bigint") + F.coalesce("_before", F.lit(0))
    return cut.with_columns({name: here}).result("_before")


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str = "total",
                slices: int | None = None) -> DataFrame:
    """Sum of ``value`` up to and including the row."""
    amount = F.col(value).cast("bigint")
    cut = slice_rows(df, list(keys), list(order), slices).carry(_before=(F.sum(amount), "sum"))
    here = F.coalesce(F.sum(amount).over(cut.upto_here), F.lit(0)) + F.coalesce("_before", F.lit(0))
    return cut.with_columns({name: here}).result("_before")


def _pairs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, identity: str,
           slices: int | None) -> DataFrame:
    """One row per two consecutive rows of a key; the last may hold one row only."""
    numbered = running_count(df.select(*dict.fromkeys([*keys, *order, value, identity])), keys, order, "_n", slices)
    pair = F.expr("(_n - 1) div 2").alias("pair_no")
    return numbered.groupBy(*keys, pair).agg(
        F.count(F.lit(1)).alias("_rows"),
        whole_mean(F.sum(F.col(value).cast("bigint")), F.count(F.lit(1))).alias("average"),
        F.min_by(identity, "_n").alias("_first"),
        F.max_by(identity, "_n").alias("_second"),
    )


def pair_average(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                 slices: int | None = None) -> DataFrame:
    """Whole-number mean of every two consecutive rows of a key; an open pair gives nothing."""
    pairs = _pairs(df, keys, order, value, order[-1], slices)
    return pairs.where("_rows = 2").select(*keys, "pair_no", "average")


def pair_average_padded(df: DataFrame, key: str, order: Sequence[str], value: str,
                        identity: str | None = None, slices: int | None = None) -> DataFrame:
    """One output per input: ``(0, 0)`` for the first row of a pair, else ``(key, mean)``."""
    identity = identity or order[-1]
    pairs = _pairs(df, [key], order, value, identity, slices)
    key_type = df.schema[key].dataType

    def output(row: Column, shown_key: Column, average: Column) -> Column:
        return F.struct(row.alias(identity), shown_key.cast(key_type).alias(key), average.cast("bigint").alias("average"))

    opening = output(F.col("_first"), F.lit(0), F.lit(0))
    closing = F.when(F.col("_rows") == 2, output(F.col("_second"), F.col(key), F.col("average")))
    return pairs.select(F.inline(F.array_compact(F.array(opening, closing))))


def running_count_with_expiry(df: DataFrame, keys: Sequence[str], order: Sequence[str], time: str, ttl: str,
                              name: str = "n", slices: int | None = None) -> DataFrame:
    """Running count that starts again once ``ttl`` has passed since the key's previous row.

    ``time`` must be the leading order column. A gap equal to ``ttl`` has expired.
    """
    if order[0] != time:
        raise ValueError("the time column must lead the order")
    cut = slice_rows(df, list(keys), list(order), slices).carry(
        _before=(F.count(F.lit(1)), "sum"), _last_time=(F.max(time), "max")
    )
    position = F.row_number().over(cut.window).cast("bigint") + F.coalesce("_before", F.lit(0))
    previous = F.coalesce(F.lag(time).over(cut.window), F.col("_last_time"))
    fresh = F.col("_previous").isNull() | (F.col(time) >= F.col("_previous") + F.expr(f"interval {ttl}"))
    cut = cut.with_columns({"_n": position, "_previous": previous, "_start": F.when(fresh, F.col("_n"))})
    cut = cut.carry(_earlier_start=(F.max("_start"), "max"))
    latest_start = F.greatest(F.max("_start").over(cut.upto_here), F.col("_earlier_start"))
    counted = cut.with_columns({name: F.col("_n") - latest_start + 1})
    return counted.result("_before", "_last_time", "_n", "_previous", "_start", "_earlier_start")


def sorted_with_rank(df: DataFrame, order: Sequence[str], name: str = "position",
                     slices: int | None = None) -> DataFrame:
    """Total order over the whole table with each row's position in it.

    End ``order`` with a unique column: equal attributes then keep a fixed order and a
    frequent attribute value still spreads over many tasks.
    """
    return running_count(df, [], order, name, slices).orderBy(*order)
