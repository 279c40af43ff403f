"""Partition choice by key hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The JVM string hash is sum(unit[i] * 31^(n-1-i)) over UTF-16 units, in 32 bits.
HASH_FACTOR = 31
WORD_MASK = 0xFFFFFFFF
FIRST_SURROGATE_PAIR = 0x10000
HIGH_SURROGATE_BASE = 0xD800
LOW_SURROGATE_BASE = 0xDC00


def string_hash(key: Column) -> Column:
    """The JVM hash code of a text, as INT."""

    def step(acc: Column, unit: Column) -> Column:
        return (acc * HASH_FACTOR + unit).bitwiseAND(F.lit(WORD_MASK))

    def add_character(acc: Column, char: Column) -> Column:
        code = F.ascii(char).cast("bigint")
        above = code - FIRST_SURROGATE_PAIR
        high = F.shiftright(above, 10) + HIGH_SURROGATE_BASE
        low = above.bitwiseAND(F.lit(0x3FF)) + LOW_SURROGATE_BASE
        return F.when(code < FIRST_SURROGATE_PAIR, step(acc, code)).otherwise(step(step(acc, high), low))

    folded = F.aggregate(F.split(key, ""), F.lit(0).cast("bigint"), add_character)
    signed = F.when(folded > 0x7FFFFFFF, folded - (WORD_MASK + 1)).otherwise(folded)
    return F.when(key == "", F.lit(0)).otherwise(signed.cast("int"))


def hash_partition(key: Column, partitions: int) -> Column:
    """``abs(hash % n)``: the partition a keyed record is sent to."""
    return F.abs(string_hash(key) % F.lit(partitions))


def spread(partitions: int, *columns: Column) -> Column:
    """An even shard number when parity with the string hash does not matter."""
    return F.pmod(F.xxhash64(*columns), F.lit(partitions)).cast("int")
