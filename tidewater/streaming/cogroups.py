"""Co-groups of a stream: the members of both sides, delivered together when their window has closed.

Groups of a window are dealt to parts. A part's members wait in the state store, one list for each side, so neither a task
nor a row holds a group: members come in by chunks, and go out by chunks when the timer at the window's end fires. What a
task holds is two numbers for each group of one part. The state goes with them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from itertools import chain, islice

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidewater.operators.joins import WINDOW
from tidewater.session import use_rocksdb
from tidewater.streaming.parts import PART, dealt, from_text

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Chunks = Iterator[pd.DataFrame]

#: Members delivered at a time.
CHUNK = 10_000
#: Parts of a window.
PARTS = 16
SIDES = ("left", "right")
#: A group's window in milliseconds; it is delivered at ``CLOSES_AT``.
CLOSES_AT, OPENS_AT = "closes_at", "opens_at"


class CoGroup(StatefulProcessor):
    """Collects ``side`` and ``payload`` of the groups of a window's part and gives them out at its ``closes_at``.

    ``groups`` names the columns, all text, that make a group; ``window`` those that make a part.
    """

    def __init__(self, window: Sequence[str], groups: Sequence[str], chunk: int):
        self.window, self.groups, self.chunk = list(window), list(groups), chunk

    def init(self, handle) -> None:
        self.handle = handle
        member = ", ".join(f"`{c}` string" for c in [*self.groups, "payload"])
        self.members = {side: handle.getListState(side, member) for side in SIDES}
        self.sizes = handle.getValueState("sizes", "n_left bigint, n_right bigint")

    def handleInputRows(self, key, rows: Chunks, timerValues) -> Chunks:
        if timerValues.getCurrentWatermarkInMs() >= key[0]:  # late: the window is closed
            return iter(())
        found = self.sizes.get()
        sizes = dict(zip(SIDES, (0, 0) if found is None else found, strict=True))
        for chunk in rows:
            for side in SIDES:
                own = chunk.loc[chunk["side"] == side, [*self.groups, "payload"]]
                if len(own):
                    texts = own.astype(object).where(own.notna(), None)
                    self.members[side].appendList(list(zip(*[texts[c].tolist() for c in texts.columns], strict=True)))
                    sizes[side] += len(own)
        self.sizes.update(tuple(int(sizes[side]) for side in SIDES))
        if found is None:
            self.handle.registerTimer(int(key[0]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Chunks:
        numbers = dict(zip(SIDES, self.sizes.get(), strict=True))
        full = [side for side in SIDES if numbers[side]]
        read = {side: self.members[side].get for side in full}
        if sum(numbers.values()) <= self.chunk:  # read once
            held = {side: list(read[side]()) for side in full}
            read = {side: (lambda side=side: held[side]) for side in full}
        n: dict[tuple, list[int]] = {}
        for side in full:
            for row in read[side]():
                n.setdefault(row[:-1], [0, 0])[SIDES.index(side)] += 1
        given: dict[tuple, int] = {}
        waiting = chain.from_iterable(((side, row) for row in read[side]()) for side in full)
        while some := list(islice(waiting, self.chunk)):
            places = []
            for _, row in some:
                given[row[:-1]] = given.get(row[:-1], 0) + 1
                places.append(given[row[:-1]])
            groups = [row[:-1] for _, row in some]
            yield pd.DataFrame({
                **{name: [value] * len(some) for name, value in zip(self.window, key, strict=True)},
                **{name: [g[i] for g in groups] for i, name in enumerate(self.groups)},
                "side": [side for side, _ in some], "place": places,
                "n_left": [n[g][0] for g in groups], "n_right": [n[g][1] for g in groups],
                "payload": [row[-1] for _, row in some]})
        for side in SIDES:
            self.members[side].clear()
        self.sizes.clear()


def delivered_groups(members: DataFrame, keys: Sequence[str], shards: int = 1, chunk: int = CHUNK,
                     parts: int = PARTS) -> DataFrame:
    """The groups of ``joins.cogroup_rows`` of two streams, each once its window has closed.

    A row for each member: ``window_start``, ``window_end``, the keys, ``side``, ``place`` (from 1 on, the left side first,
    each side in the order of arrival), ``n_left`` and ``n_right``, the numbers of members on either side, and ``payload``.
    A group with members on one side only is delivered too. Both streams need a watermark on their time; a row is late, and
    left out, when its window has closed on the slower one.

    A group is one task's work. Where one key may have a large part of all rows, ``shards`` delivers every group in so many
    parts, numbered ``shard``, by a hash of the payload; place and numbers are those of the part.

    The groups of a window are dealt to ``parts``, each handled by one call: with many small groups, fewer parts are faster,
    but no more tasks than that work on a window.
    """
    groups, window = ["shard", *keys], [CLOSES_AT, OPENS_AT, PART]
    kept = members.select(
        F.unix_millis(F.col(WINDOW)["end"]).alias(CLOSES_AT), F.unix_millis(F.col(WINDOW)["start"]).alias(OPENS_AT),
        F.pmod(F.xxhash64("payload"), F.lit(shards)).cast("int").alias("shard"), *keys, "side",
        F.col("payload").cast("string").alias("payload"))
    kinds = {c: kept.schema[c].dataType for c in groups}
    kept = dealt(kept, groups, parts)
    use_rocksdb(members.sparkSession)
    rest = [("side", T.StringType()), ("place", T.LongType()), ("n_left", T.LongType()), ("n_right", T.LongType()),
            ("payload", T.StringType())]
    schema = T.StructType([*[kept.schema[c] for c in [*window, *groups]], *[T.StructField(n, kind) for n, kind in rest]])
    found = kept.groupBy(*window).transformWithStateInPandas(
        statefulProcessor=CoGroup(window, groups, chunk), outputStructType=schema, outputMode="append", timeMode="eventTime")
    return found.select(
        F.timestamp_millis(OPENS_AT).alias("window_start"), F.timestamp_millis(CLOSES_AT).alias("window_end"),
        *[from_text(c, kinds[c]) for c in (groups if shards > 1 else keys)], "side", "place", "n_left", "n_right",
        F.col("payload").cast(members.schema["payload"].dataType).alias("payload"))
