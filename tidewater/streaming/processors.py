"""Per-key state for results that depend on the rows before.

Rows arrive in Arrow chunks and are handled chunk by chunk, so a key's rows are never
held together; the state of a key is one small value or one map. As in any such
stream, the order is the order of arrival.

A query's number of state stores is fixed for the life of its checkpoint. ``initial`` is what
another query has kept, as ``rescaling.kept_state`` reads it: a query begins with it under a checkpoint of
its own, in as many stores as it likes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidewater.session import use_rocksdb
from tidewater.streaming.parts import PART, dealt, from_text

# Executors get the processors with the job, without this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Chunks = Iterator[pd.DataFrame]

# Chunks do not keep the names of columns that start with an underscore.
AMOUNT = "amount_to_add"


def _stored(state, default: tuple) -> tuple:
    found = state.get()
    return default if found is None else tuple(found)


class RunningTotal(StatefulProcessor):
    """Adds ``name``: the sum of ``value`` up to each row."""

    def __init__(self, value: str, name: str):
        self.value, self.name = value, name

    def init(self, handle) -> None:
        self.state = handle.getValueState("total", "total bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((int(initialState["total"].iloc[0]),))

    def handleInputRows(self, key, rows: Chunks, timerValues) -> Chunks:
        (total,) = _stored(self.state, (0,))
        for chunk in rows:
            totals = chunk[self.value].cumsum() + total
            total = int(totals.iloc[-1])
            yield chunk.assign(**{self.name: totals})
        self.state.update((total,))


class PartTotals(StatefulProcessor):
    """``RunningTotal`` for all keys of a part: what is kept is a list of keys, as text, and their totals."""

    def __init__(self, keys: Sequence[str], value: str, name: str):
        self.keys, self.value, self.name = list(keys), value, name

    def init(self, handle) -> None:
        self.state = handle.getListState("total", ", ".join([*(f"`{k}` string" for k in self.keys), "total bigint"]))

    def _of(self, rows: pd.DataFrame) -> list[tuple]:
        """The keys of rows; text compares as text, and nulls are alike."""
        texts = rows[self.keys].astype(object)
        return list(zip(*[texts[k].where(texts[k].notna(), None).tolist() for k in self.keys], strict=True))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        totals = initialState["total"].tolist()
        self.state.appendList([(*k, int(total)) for k, total in zip(self._of(initialState), totals, strict=True)])

    def handleInputRows(self, key, rows: Chunks, timerValues) -> Chunks:
        numbers: dict[tuple, int] = {}
        totals: list[int] = []
        for row in self.state.get():
            numbers[row[:-1]] = len(numbers)
            totals.append(int(row[-1]))
        for chunk in rows:
            codes = np.array([numbers.setdefault(k, len(numbers)) for k in self._of(chunk)])
            totals += [0] * (len(numbers) - len(totals))
            before = np.array(totals, dtype="int64")
            sums = chunk[self.value].groupby(codes, sort=False).cumsum().to_numpy() + before[codes]
            before[codes] = sums  # of equal codes the last one stays
            totals = before.tolist()
            yield chunk.assign(**{self.name: sums})
        self.state.put([(*k, total) for k, total in zip(numbers, totals, strict=True)])


class PairMean(StatefulProcessor):
    """Whole-number mean of every two rows; ``padded`` also emits ``(0, 0)`` for a first row."""

    def __init__(self, key: str, value: str, padded: bool):
        self.key, self.value, self.padded = key, value, padded

    def init(self, handle) -> None:
        self.state = handle.getValueState("open_pair", "rows bigint, total bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((int(initialState["rows"].iloc[0]), int(initialState["total"].iloc[0])))

    def handleInputRows(self, key, rows: Chunks, timerValues) -> Chunks:
        count, total = _stored(self.state, (0, 0))
        for chunk in rows:
            values = chunk[self.value].to_numpy(dtype="int64")
            opened = int(count)
            if opened:
                values = np.concatenate([[total], values])
            whole = len(values) // 2
            sums = values[: 2 * whole : 2] + values[1 : 2 * whole : 2]
            means = np.abs(sums) // 2 * np.sign(sums)
            count, total = len(values) % 2, int(values[-1]) if len(values) % 2 else 0
            if self.padded:
                shown = np.zeros(len(values), dtype="int64")
                shown[1 : 2 * whole : 2] = means
                keys = np.where(np.arange(len(values)) % 2 == 1, key[0], 0)
                yield pd.DataFrame({self.key: keys[opened:], "average": shown[opened:]})
            else:
                yield pd.DataFrame({self.key: np.full(whole, key[0]), "average": means})
        self.state.update((count, total))


class CountPerItem(StatefulProcessor):
    """Adds ``name``: how often the key has had this item; an item expires ``ttl_millis`` after its last row."""

    def __init__(self, item: str, name: str, ttl_millis: int | None):
        self.item, self.name, self.ttl_millis = item, name, ttl_millis

    def init(self, handle) -> None:
        self.state = handle.getMapState("counts", "item string", "n bigint", self.ttl_millis)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for item, n in zip(initialState["item"], initialState["n"], strict=True):
            self.state.updateValue((None if pd.isna(item) else item,), (int(n),))

    def handleInputRows(self, key, rows: Chunks, timerValues) -> Chunks:
        counts: dict[str, int] = {}
        for chunk in rows:
            codes, items = pd.factorize(chunk[self.item], use_na_sentinel=False)
            for item in items:
                if item not in counts:
                    found = self.state.getValue((item,))
                    counts[item] = 0 if found is None else int(found[0])
            before = np.array([counts[item] for item in items])
            sizes = np.bincount(codes)
            by_item = np.argsort(codes, kind="stable")
            totals = np.empty(len(codes), dtype="int64")
            totals[by_item] = np.arange(1, len(codes) + 1) + np.repeat(before - (np.cumsum(sizes) - sizes), sizes)
            counts.update(zip(items, (before + sizes).tolist(), strict=True))
            yield chunk.assign(**{self.name: totals})
        for item, n in counts.items():
            self.state.updateValue((item,), (n,))


class CountChanges(StatefulProcessor):
    """Each row adds the key's new count and, but for the first, withdraws the old one."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle) -> None:
        self.state = handle.getValueState("n", "n bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((int(initialState["n"].iloc[0]),))

    def handleInputRows(self, key, rows: Chunks, timerValues) -> Chunks:
        (n,) = _stored(self.state, (0,))
        for chunk in rows:
            counts = np.repeat(np.arange(n + 1, n + len(chunk) + 1), 2)
            adds = np.tile([False, True], len(chunk))
            counts = counts - ~adds
            first = 1 if n == 0 else 0
            n += len(chunk)
            yield pd.DataFrame({self.key: key[0], "is_add": adds[first:], "n": counts[first:]})
        self.state.update((n,))


def _apply(df: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema: T.StructType,
           time_mode: str = "none", initial: DataFrame | None = None) -> DataFrame:
    unfit = [c for c in df.columns if c.startswith("_")]
    if unfit:
        raise ValueError(f"rename columns that start with an underscore: {unfit}")
    use_rocksdb(df.sparkSession)
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode=time_mode,
        initialState=None if initial is None else initial.groupBy(*keys))


def _pass_through(df: DataFrame, keys: Sequence[str], processor: StatefulProcessor, name: str, computed: str | None = None,
                  time_mode: str = "none", initial: DataFrame | None = None) -> DataFrame:
    """Rows go through a processor and come back with ``name`` added.

    pandas turns whole numbers with nulls among them into floats, so those that are only
    passed on travel as text. ``computed`` is a column without nulls made for the processor.
    """
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, T.LongType)} - {*keys, computed}
    sent = df.select(*[F.col(c).cast("string").alias(c) if c in whole else F.col(c) for c in df.columns])
    schema = T.StructType([*sent.schema.fields, T.StructField(name, T.LongType())])
    back = _apply(sent, keys, processor, schema, time_mode, _as_sent(initial, sent, keys))
    kept = [F.col(c).cast("bigint").alias(c) if c in whole else F.col(c) for c in df.columns if c != computed]
    return back.select(*kept, name)


def _as_sent(initial: DataFrame | None, sent: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Kept state with keys of the types the rows have."""
    if initial is None:
        return None
    return initial.select(*[from_text(c, sent.schema[c].dataType) if c in keys and initial.schema[c].dataType == T.StringType()
                            else F.col(c).cast(sent.schema[c].dataType) if c in keys else F.col(c) for c in initial.columns])


def running_sum(df: DataFrame, keys: Sequence[str], value: str, name: str = "total",
                initial: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """``df`` and ``name``, the sum of ``value`` up to each row of the keys.

    With ``parts`` the keys are dealt to so many, each handled by one call and kept as one list, which is written anew when
    a micro-batch has rows of it: for many keys with few rows. Some hundred keys in a part are a good number.
    """
    amounts = df.withColumn(AMOUNT, F.coalesce(F.col(value).cast("bigint"), F.lit(0)))
    if parts is None:
        return _pass_through(amounts, keys, RunningTotal(AMOUNT, name), name, computed=AMOUNT, initial=initial)
    if initial is not None:
        initial = dealt(_as_sent(initial, df, keys), keys, parts)
    summed = _pass_through(dealt(amounts, keys, parts), [PART], PartTotals(keys, AMOUNT, name), name, AMOUNT, initial=initial)
    return summed.select(*[from_text(c, df.schema[c].dataType) if c in keys else c for c in df.columns], name)


def pair_average(df: DataFrame, key: str, value: str, padded: bool = False, initial: DataFrame | None = None) -> DataFrame:
    """``key, average`` of every two rows of a whole-number key."""
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField("average", T.LongType())])
    rows = df.select(F.col(key).cast("bigint"), F.coalesce(F.col(value).cast("bigint"), F.lit(0)).alias(value))
    return _apply(rows, [key], PairMean(key, value, padded), schema, initial=_as_sent(initial, rows, [key]))


def count_per_item(df: DataFrame, keys: Sequence[str], item: str, name: str = "n",
                   ttl_millis: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """With ``ttl_millis`` the query runs on processing time: give it an interval trigger."""
    mode = "none" if ttl_millis is None else "processingTime"
    return _pass_through(df, keys, CountPerItem(item, name, ttl_millis), name, time_mode=mode, initial=initial)


def count_changes(df: DataFrame, key: str, initial: DataFrame | None = None) -> DataFrame:
    schema = T.StructType([
        df.schema[key], T.StructField("is_add", T.BooleanType()), T.StructField("n", T.LongType())])
    rows = df.select(key)
    return _apply(rows, [key], CountChanges(key), schema, initial=_as_sent(initial, rows, [key]))


def totals(df: DataFrame, keys: Sequence[str], value: str, name: str = "total") -> DataFrame:
    """Newest sum per key in ``update`` mode; summed before the shuffle, so a hot key is cheap."""
    return df.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(name))


def sharded_count(df: DataFrame, identity: str, shards: int, name: str = "n") -> DataFrame:
    """A counter kept in parts: ``shard, n`` in ``update`` mode. The total is the sum of the parts."""
    shard = F.pmod(F.xxhash64(identity), F.lit(shards)).cast("int").alias("shard")
    return df.groupBy(shard).agg(F.count(F.lit(1)).alias(name))


def shard_total(parts: DataFrame, name: str = "n") -> DataFrame:
    return parts.agg(F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name))
