"""Counts that expire by event time.

Rows wait in the state until the watermark has passed them and are then counted in the order of their times, so the result
does not depend on the order of arrival. A timer at a count's expiry removes it when the watermark gets there, also when
the key never has a row again.
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

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Chunks = Iterator[pd.DataFrame]
AT = "at_micros"


def _millis(micros: int) -> int:
    """The first millisecond that is not before."""
    return -(-micros // 1000)


class ExpiringCount(StatefulProcessor):
    """Numbers a key's rows by event time, from one again after ``ttl`` microseconds without a row."""

    def __init__(self, keys: Sequence[str], identity: str, kind: str, ttl: int, name: str):
        self.keys, self.identity, self.kind, self.ttl, self.name = list(keys), identity, kind, ttl, name

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"at bigint, id {self.kind}")
        self.count = handle.getValueState("count", "n bigint, last bigint")

    def handleInputRows(self, key, rows: Chunks, timerValues) -> Chunks:
        passed, first = timerValues.getCurrentWatermarkInMs(), None
        for chunk in rows:
            at, ids = chunk[AT].tolist(), chunk[self.identity].tolist()
            fresh = [(a, i) for a, i in zip(at, ids, strict=True) if _millis(a) > passed]
            if fresh:
                self.waiting.appendList(fresh)
                earliest = min(fresh)[0]
                first = earliest if first is None else min(first, earliest)
        if first is not None:
            self.handle.registerTimer(_millis(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Chunks:
        passed = timerValues.getCurrentWatermarkInMs()
        waiting = sorted((int(at), i) for at, i in self.waiting.get())
        ready = [row for row in waiting if _millis(row[0]) <= passed]
        found = self.count.get()
        n, last = (0, 0) if found is None else (int(found[0]), int(found[1]))
        if ready:
            later = waiting[len(ready):]
            if later:
                self.waiting.put(later)
                self.handle.registerTimer(_millis(later[0][0]))
            else:
                self.waiting.clear()
            times = np.array([at for at, _ in ready])
            starts = np.diff(times, prepend=last) >= self.ttl
            starts[0] |= n == 0
            place = np.arange(1, len(times) + 1)
            # Rows before the latest start do not count; before the first start, the rows counted earlier do.
            since = np.maximum.accumulate(np.where(starts, place - 1, -n))
            counts = place - since
            n, last = int(counts[-1]), int(times[-1])
            yield pd.DataFrame({
                self.identity: [i for _, i in ready],
                **{k: [v] * len(ready) for k, v in zip(self.keys, key, strict=True)}, self.name: counts})
        if n and _millis(last + self.ttl) <= passed:
            self.count.clear()
        elif ready:
            self.count.update((n, last))
            self.handle.registerTimer(_millis(last + self.ttl))


class PartExpiringCounts(StatefulProcessor):
    """``ExpiringCount`` for all keys of a part: rows and counts wait in lists with their keys, as text."""

    def __init__(self, keys: Sequence[str], identity: str, kind: str, ttl: int, name: str):
        self.keys, self.identity, self.kind, self.ttl, self.name = list(keys), identity, kind, ttl, name

    def init(self, handle) -> None:
        self.handle = handle
        key = ", ".join(f"`{k}` string" for k in self.keys)
        self.waiting = handle.getListState("waiting", f"{key}, at bigint, id {self.kind}")
        self.count = handle.getListState("count", f"{key}, n bigint, last bigint")

    def handleInputRows(self, key, rows: Chunks, timerValues) -> Chunks:
        passed, first = timerValues.getCurrentWatermarkInMs(), None
        for chunk in rows:
            chunk = chunk[-(-chunk[AT] // 1000) > passed]
            if len(chunk):
                texts = chunk[self.keys].astype(object)
                texts = [texts[k].where(texts[k].notna(), None).tolist() for k in self.keys]
                self.waiting.appendList(list(zip(*texts, chunk[AT].tolist(), chunk[self.identity].tolist(), strict=True)))
                earliest = int(chunk[AT].min())
                first = earliest if first is None else min(first, earliest)
        if first is not None:
            self.handle.registerTimer(_millis(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Chunks:
        passed = timerValues.getCurrentWatermarkInMs()
        numbers: dict[tuple, int] = {}
        kept: list[list[int]] = []
        for row in self.count.get():
            numbers[row[:-2]] = len(kept)
            kept.append([int(row[-2]), int(row[-1])])
        ready, later = [], []
        for row in self.waiting.get():
            if _millis(row[-2]) <= passed:
                ready.append((numbers.setdefault(row[:-2], len(numbers)), int(row[-2]), row[-1]))
            else:
                later.append(row)
        kept += [[0, 0]] * (len(numbers) - len(kept))
        if ready:
            ready.sort()
            of, times = np.array([r[0] for r in ready]), np.array([r[1] for r in ready])
            n, last = (np.array(column) for column in zip(*kept, strict=True))
            first = np.diff(of, prepend=-1) != 0
            starts = np.where(first, times - last[of], np.diff(times, prepend=0)) >= self.ttl
            starts |= first & (n[of] == 0)
            # Counted from a key's latest start; before the first, the rows counted earlier count too.
            place = np.arange(len(times))
            since = np.maximum.accumulate(np.where(first | starts, place, 0))
            counts = place - since + 1 + np.where(starts[since], 0, n[of])
            n[of], last[of] = counts, times  # of equal keys the last one stays
            kept = np.stack([n, last], 1).tolist()
            names = list(numbers)
            yield pd.DataFrame({
                self.identity: [r[2] for r in ready],
                **{k: [names[o][i] for o in of] for i, k in enumerate(self.keys)}, self.name: counts})
            if later:
                self.waiting.put(later)
            else:
                self.waiting.clear()
        alive = [(*k, *c) for k, c in zip(numbers, kept, strict=True) if _millis(c[1] + self.ttl) > passed]
        if alive:
            self.count.put(alive)
        elif kept:
            self.count.clear()
        due = [*(_millis(row[-2]) for row in later), *(_millis(c[-1] + self.ttl) for c in alive)]
        if due:
            self.handle.registerTimer(min(due))


def count_with_expiry(df: DataFrame, keys: Sequence[str], time: str, identity: str, ttl_seconds: int, name: str = "n",
                      parts: int | None = None) -> DataFrame:
    """``identity``, the keys and ``name``: how many rows the key has had since a gap of ``ttl_seconds`` or more.

    A stream with a watermark on ``time``; a row comes out when the watermark has passed it, and is left out when it
    arrives later. Rows of one time are ordered by ``identity``, a column without nulls. What a key's rows between two
    watermarks come to is sorted in memory: for keys with a large part of all rows use ``carried``.

    With ``parts`` the keys are dealt to so many, each handled by one call and kept as two lists, which are read and written
    anew when a timer of it comes: for many keys with few rows. A part's rows are then what is sorted in memory.
    """
    field = df.schema[identity]
    sent = df.where(F.col(time).isNotNull()).select(*keys, identity, F.unix_micros(F.col(time)).alias(AT))
    use_rocksdb(df.sparkSession)
    schema = T.StructType([field, *[df.schema[k] for k in keys], T.StructField(name, T.LongType())])
    given = (keys, identity, field.dataType.simpleString(), ttl_seconds * 1_000_000, name)
    if parts is not None:
        texts = T.StructType([field, *[T.StructField(k, T.StringType()) for k in keys], schema[name]])
        counted = dealt(sent, keys, parts).groupBy(PART).transformWithStateInPandas(
            statefulProcessor=PartExpiringCounts(*given), outputStructType=texts, outputMode="append", timeMode="eventTime")
        return counted.select(identity, *[from_text(k, df.schema[k].dataType) for k in keys], name)
    return sent.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=ExpiringCount(*given), outputStructType=schema, outputMode="append", timeMode="eventTime")
