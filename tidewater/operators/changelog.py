"""Tables as change streams: ``is_add`` true adds a row, false withdraws it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.running import running_count

IS_ADD = "is_add"


def append_only(df: DataFrame) -> DataFrame:
    """A table that only grows: every change is an addition."""
    return df.select(F.lit(True).alias(IS_ADD), "*")


def changes_of(counted: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """From running counts to changes: each row adds its count and, but for a key's first, withdraws the one before."""
    n = F.col(count)
    added = F.struct(F.lit(True).alias(IS_ADD), n.alias("n"))
    withdrawn = F.when(n > 1, F.struct(F.lit(False).alias(IS_ADD), (n - 1).alias("n")))
    return counted.select(*keys, F.inline(F.array_compact(F.array(withdrawn, added))))


def count_changes(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Changes of ``count(*) group by keys`` as the rows come in."""
    return changes_of(running_count(df.select(*dict.fromkeys([*keys, *order])), keys, order, "n", slices), keys)
