"""Best-fit packing of documents into sequences of a fixed number of tokens, by minimum bin slack.

Only documents longer than a sequence are cut. What matters for packing is how many pieces there are of each length,
at most ``capacity`` numbers however large the corpus is. Over these counts the driver fills bins: each takes the
longest piece left, and a subset-sum over the lengths left, held as the bits of one integer, finds the fullest
combination beside it. A combination stays the fullest as long as its pieces last, so it is taken as often as they do.
Pieces are numbered within their length and look up the combination, bin and place of their number.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import saved
from tidewater.llm.tokens import encoder

#: Texts encoded at a time by a task, in characters; a longer text goes alone.
CHUNK_CHARS = 4_000_000


def fullest(room: int, lengths: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ``(length, times)`` that together come nearest to ``room`` from below; ``lengths`` has (length, count)."""
    if room <= 0:
        return []
    mask, reach, trail = (1 << (room + 1)) - 1, 1, []
    for length, count in lengths:
        for _ in range(min(count, room // length)):
            more = (reach | reach << length) & mask
            if more == reach:
                break
            trail.append((length, reach))
            reach = more
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, []
    for length, before in reversed(trail):
        if not before >> at & 1:
            chosen.append(length)
            at -= length
    return [(length, len(list(same))) for length, same in groupby(chosen)]


def combinations(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(bins, [(length, pieces in each)])`` that use up ``counts``: ``{length: pieces}``."""
    left, out = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        rest = fullest(capacity - longest, [(n, c) for n, c in sorted(left.items(), reverse=True) if c > 0])
        left[longest] += 1
        used = {longest: 1}
        for n, c in rest:
            used[n] = used.get(n, 0) + c
        bins = min(left[n] // c for n, c in used.items())
        for n, c in used.items():
            left[n] -= bins * c
            if not left[n]:
                del left[n]
        out.append((bins, sorted(used.items(), reverse=True)))
    return out


def _cutter(path: str, capacity: int, end_id: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, part, seen = encoder(path), TaskContext.get().partitionId(), [0] * (capacity + 1)
        closing = end_id.to_bytes(4, "little")

        def pieces(ids: list, texts: list[str]) -> pa.RecordBatch:
            out: list[tuple] = []
            for doc_id, packed in zip(ids, encode.batch(texts), strict=True):
                packed += closing
                n = len(packed) // 4
                start, piece = 0, 0
                while start < n:
                    size = (n - start) % capacity or capacity
                    own = packed[4 * start: 4 * (start + size)]
                    out.append((doc_id, piece, start, size, zlib.crc32(own), part, seen[size],
                                memoryview(own).cast("I").tolist() if keep_ids else None))
                    seen[size] += 1
                    start, piece = start + size, piece + 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(),
                     pa.list_(pa.int32())]
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            ids, texts, chars = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if chars >= CHUNK_CHARS:
                    yield pieces(ids, texts)
                    ids, texts, chars = [], [], 0
            if ids:
                yield pieces(ids, texts)

    return cut


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """A row for each piece of each row of ``docs`` (``doc_id``, ``text``): its place in a sequence.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if ``keep_ids``, ``ids``. A document's tokens
    are those of its text, then ``end_id``; the first piece of a longer one takes what doesn't fill a whole sequence.

    Nulls: a null text is empty, so only ``end_id`` is packed; a null ``doc_id`` stays null. Each repeated row is packed
    for itself. No documents give no rows. Other columns are left out, whatever their names.
    """
    spark = docs.sparkSession
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long, ids array<int>")
    cut = docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(
        _cutter(tokenizer_path, capacity, end_id, keep_ids), schema)
    pieces = saved(cut if keep_ids else cut.drop("ids"))
    # A row for each writing task and length; running sums of a length's rows number its pieces through all tasks.
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).drop("n")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranges, bins, used = [], 0, {}
    for times, parts in combinations(counts, capacity):
        offset = 0
        for length, each in parts:
            low = used.get(length, 0)
            used[length] = low + times * each
            ranges.append((length, low, used[length], each, bins, offset))
            offset += length * each
        bins += times
    # At most a few rows for each length up to the capacity, so they may be broadcast.
    places = F.broadcast(spark.createDataFrame(
        ranges, "length long, low long, high long, each long, first long, base long"))
    number = F.col("before") + F.col("nth")
    nth = number - F.col("low")
    placed = pieces.join(by_part, ["part", "length"]).join(
        places, (pieces["length"] == places["length"]) & (number >= F.col("low")) & (number < F.col("high")))
    return placed.select(
        "doc_id", "piece", "start", pieces["length"].alias("length"), "ids_crc32",
        (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("base") + (nth % F.col("each")) * pieces["length"]).cast("long").alias("offset"),
        *(["ids"] if keep_ids else []))
