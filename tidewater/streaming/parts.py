"""Keys dealt to parts, so that a processor's call handles all keys of a part.

A call has a price of its own, some milliseconds of messages to the state store. Where most keys have a few rows only, it
is nearly all of the work. The keys' values travel with the rows as text, as pandas turns whole numbers with nulls into floats.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The column that says which part a row is of.
PART = "part_of_keys"


def as_text(name: str, kind: T.DataType) -> Column:
    """A key's text, the same for equal keys."""
    column = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (column + F.lit(0.0)).cast("string")  # no negative zero
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        raise ValueError(f"{name} is no single value")
    return column.cast("string")


def from_text(name: str, kind: T.DataType) -> Column:
    """The key that ``as_text`` was given."""
    column = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(column.cast("bigint")).alias(name)
    if isinstance(kind, T.BinaryType):
        return F.unhex(column).alias(name)
    return column.cast(kind).alias(name)


def dealt(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """``df`` with ``keys`` as text and their part, a number below ``parts``."""
    if parts < 1:
        raise ValueError("at least one part")
    texts = df.select(*[as_text(c, df.schema[c].dataType).alias(c) if c in keys else F.col(c) for c in df.columns])
    return texts.withColumn(PART, F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
