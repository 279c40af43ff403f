"""Union, connect, split and side outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTPUTS = "outputs"


def union(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)


def connect(left: DataFrame, right: DataFrame, left_value: Column, right_value: Column,
            name: str = "value") -> DataFrame:
    """Two differently typed inputs, each mapped to one common column.

    Rows whose mapping is null are dropped, as a mapping may give no output.
    """
    both = union(left.select(left_value.alias(name)), right.select(right_value.alias(name)))
    return both.where(F.col(name).isNotNull())


def tag(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Name the outputs each row belongs to; a row may have several or none."""
    names = [F.when(condition, F.lit(name)) for name, condition in rules.items()]
    return df.withColumn(OUTPUTS, F.array_compact(F.array(*names)))


def select_output(tagged: DataFrame, *names: str) -> DataFrame:
    wanted = F.arrays_overlap(OUTPUTS, F.array(*[F.lit(n) for n in names]))
    return tagged.where(wanted).drop(OUTPUTS)


def side_output(df: DataFrame, to_side: Column) -> tuple[DataFrame, DataFrame]:
    """``(main, side)``; a null condition stays in main."""
    flagged = F.coalesce(to_side, F.lit(False))
    return df.where(~flagged), df.where(flagged)
