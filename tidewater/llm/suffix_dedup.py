"""Exact removal of long strings that an earlier document has, by maximal repeats from enhanced suffix arrays.

A suffix array of a whole corpus doesn't fit one task, so it is cut where no repeat is cut. Every string of ``length``
bytes has an anchor: the place of its smallest hash of ``GRAM`` bytes, the leftmost of equal ones. Equal strings have
equal anchors. Consecutive strings with the same anchor make one context, at most ``2 * length - GRAM`` bytes, so all
occurrences of a string are in contexts of one anchor's bytes, and these are few but for hot ones.

1. The anchors' hashes are compared between blocks of documents, packed as numbers of four bytes; those that only one
   document has end here. A chance equality keeps an anchor that isn't needed and changes no result.
2. A context that several documents have is removed whole from all but the first of them.
3. Different contexts of the same anchor go into one enhanced suffix array. A scan with a stack over its common prefixes
   makes the tree of intervals; an interval whose suffixes are preceded by different bytes, or by none, is a maximal
   repeat, and is given with all its occurrences. Each is removed from all documents but the first that has it.
4. If more than ``PAGE`` different contexts share an anchor, their strings of ``length`` bytes are grouped by their hashes
   instead, with the first document of each, by partial aggregation: no task gets all contexts of a hot anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import distinct_texts, dropped, saved, settled, small_side, wide_key
from tidewater.llm.near_duplicates import mixed
from tidewater.llm.substring_dedup import sliding_minimum

LENGTH, GRAM = 50, 16
#: Different contexts of one suffix array; bytes of text in a block of documents; parts the anchors' hashes are dealt to.
PAGE, BLOCK_BYTES, PARTS = 64, 4_000_000, 64
RUN_BYTES = 200_000
#: Parts of the texts whose contexts are fetched, and of the anchors whose contexts are placed, one after the other.
TEXT_TURNS, TURNS = 2, 4


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of four bytes of the ``GRAM`` = 16 bytes from each place on; it only picks anchors."""
    two = data[:-1].astype(np.uint32) | data[1:].astype(np.uint32) << np.uint32(8)
    four, n = two[:-2] | two[2:] << np.uint32(16), len(data) - GRAM + 1
    out = four[:n] * np.uint32(0x9E3779B1)
    for k, factor in ((4, 0x85EBCA77), (8, 0xC2B2AE3D), (12, 0x27D4EB2F)):
        out ^= four[k: k + n] * np.uint32(factor)
        out ^= out >> np.uint32(15)
    out *= np.uint32(0x165667B1)
    return out ^ out >> np.uint32(16)


def _contexts_of(data: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none
    hashes = gram_hashes(data)
    width = length - GRAM + 1
    least = sliding_minimum(hashes, width)
    inside = text[: len(least)] == text[length - 1:]
    # A place is an anchor if it equals the greatest minimum of the runs that hold it.
    edge = np.zeros(width - 1, np.uint32)
    greatest = ~sliding_minimum(~np.concatenate([edge, np.where(inside, least, np.uint32(0)), edge]), width)
    is_anchor = greatest == hashes
    places, starts = np.flatnonzero(is_anchor), np.flatnonzero(inside)
    if not len(starts):
        return none.astype(np.uint64), none, none
    own = (np.cumsum(is_anchor) - is_anchor)[starts]  # the first anchor from a start on
    while True:
        other = np.flatnonzero(hashes[places[own]] != least[starts])
        if not len(other):
            break
        own[other] += 1
    first = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)))
    last = np.append(first[1:], len(starts)) - 1
    grams = np.lib.stride_tricks.sliding_window_view(data, GRAM)[places[own[first]]].copy().view(np.uint64)
    names = mixed(mixed(grams[:, 0]) + grams[:, 1] * np.uint64(0x9E3779B97F4A7C15))
    return names, starts[first], starts[last]


def contexts(data: np.ndarray, text: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``anchor, low, high``: each run of strings ``low..high`` (starts) with one anchor, named by a hash of its bytes.

    ``text`` says which text a byte is of. Texts are taken together up to ``RUN_BYTES``, which stay in a core's cache.
    """
    begins = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.zeros(0, np.int64)
    cuts = begins[np.flatnonzero(np.append(True, np.diff(begins // RUN_BYTES) > 0))] if len(begins) else begins
    names, lows, highs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low, high in zip(cuts, [*cuts[1:], len(data)], strict=True):
        name, a, b = _contexts_of(data[low:high], text[low:high], length)
        names.append(name)
        lows.append(a + low)
        highs.append(b + low)
    return np.concatenate(names), np.concatenate(lows), np.concatenate(highs)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def maximal_repeats(strings: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """``(size, [(string, place)])``: repeats of ``length`` bytes or more that all their occurrences can't be extended by."""
    array = sorted((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s) - length + 1))
    before = [strings[k][i - 1] if i else -1 - n for n, (_, k, i) in enumerate(array)]
    stack: list[tuple[int, int, set]] = []  # common prefix, first row, bytes before
    for n in range(1, len(array) + 1):
        common = common_prefix(array[n - 1][0], array[n][0]) if n < len(array) else 0
        common = common if common >= length else 0
        low, seen = n - 1, {before[n - 1]}
        while stack and stack[-1][0] > common:
            size, low, own = stack.pop()
            own |= seen
            if len(own) > 1:
                yield size, [(k, i) for _, k, i in array[low:n]]
            seen = own
        if common:
            if stack and stack[-1][0] == common:
                stack[-1][2].update(seen)
            else:
                stack.append((common, low, set(seen)))


def any_repeat(strings: list[bytes], length: int = LENGTH) -> bool:
    """Whether some string of ``length`` bytes stands in ``strings`` twice: of most anchors none does, no array is needed."""
    met = [s[i: i + length] for s in strings for i in range(len(s) - length + 1)]
    return len(set(met)) < len(met)


def _bytes_of(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    return (np.frombuffer(b"".join(raw), np.uint8), np.repeat(np.arange(len(raw), dtype=np.int32), sizes),
            np.cumsum(sizes) - sizes)


def _packed_anchors(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    """The block's anchors by part: those of one of its documents, and those of several."""
    data, text, _ = _bytes_of(block["text"])
    hashes, low, _ = contexts(data, text)
    both = np.unique(hashes >> np.uint64(32) << np.uint64(32) | text[low].astype(np.uint64))
    values, times = np.unique(both >> np.uint64(32), return_counts=True)
    part = (values % np.uint64(PARTS)).astype(np.int64)
    rows = []
    for p in np.unique(part):
        own = part == p
        rows.append((int(p), key[0], values[own & (times == 1)].astype(np.uint32).tobytes(),
                     values[own & (times > 1)].astype(np.uint32).tobytes()))
    return pd.DataFrame(rows, columns=["part", "block", "once", "more"])


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in ``ordered``: looked up, so that the work grows with ``values`` alone."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _shared(part: pd.DataFrame) -> pd.DataFrame:
    """For each block the anchors of the part that some other document has too."""
    once = [np.frombuffer(x, np.uint32) for x in part["once"]]
    more = [np.frombuffer(x, np.uint32) for x in part["more"]]
    values, times = np.unique(np.concatenate([*once, *more, *more]), return_counts=True)
    common = values[times > 1]
    return pd.DataFrame({"block": part["block"], "anchors": [
        own[among(own, common)].tobytes() for own in map(np.concatenate, zip(once, more, strict=True))]})


CONTEXT = "anchor long, node long, start int, context binary"


def _contexts(key: tuple, block: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
    data, text, first = _bytes_of(block["text"])
    hashes, low, high = contexts(data, text)
    wanted = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(x, np.uint32) for x in anchors["anchors"])])
    use = among((hashes >> np.uint64(32)).astype(np.uint32), np.sort(wanted))
    hashes, low, high = hashes[use], low[use], high[use]
    raw, own = data.tobytes(), text[low]
    return pd.DataFrame({
        "anchor": hashes.view(np.int64), "node": block["node"].to_numpy()[own], "start": (low - first[own]).astype(np.int32),
        "context": [raw[a: b + LENGTH] for a, b in zip(low.tolist(), high.tolist(), strict=True)]})


def _fetched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the contexts that are looked for in each text."""
    for batch in batches:
        rows = []
        for node, text, own in zip(batch["node"], batch["text"], batch["own"], strict=True):
            raw = text.encode()
            rows += [(o["anchor"], o["key"], o["n"], node, raw[o["start"]: o["start"] + o["size"]]) for o in own]
        yield pd.DataFrame(rows, columns=["anchor", "key", "n", "node", "context"])


def _scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each context the pieces that a context of an earlier document has; rows come in the order of their anchors."""
    def solved(rows: list) -> list:
        pieces: dict[int, list] = {}
        strings = [r.context for r in rows]
        if not any_repeat(strings):
            return []
        for size, places in maximal_repeats(strings):
            earliest = min(rows[k].node for k, _ in places)
            for k, i in places:
                if rows[k].node > earliest:
                    pieces.setdefault(k, []).append((i, i + size))
        return [(rows[k].anchor, rows[k].key, own) for k, own in pieces.items()]

    waiting: list = []
    for batch in batches:
        out = []
        for r in batch.itertuples(index=False):
            if waiting and waiting[0].anchor != r.anchor:
                out += solved(waiting)
                waiting = []
            waiting.append(r)
        if out:
            yield pd.DataFrame(out, columns=["anchor", "key", "pieces"])
    if waiting and (out := solved(waiting)):
        yield pd.DataFrame(out, columns=["anchor", "key", "pieces"])


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``node, low, high``: stretches of bytes whose every string of 50 bytes an earlier one of ``texts`` has, or a part.

    ``texts`` has ``node`` and ``text``; the smaller node is the earlier. The union of a node's spans is what is to go.
    """
    blocks = max(1, -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES))
    dealt = texts.select("node", "text", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block"))
    long_enough = dealt.where(F.octet_length("text") >= LENGTH)
    packed = long_enough.groupBy("block").applyInPandas(_packed_anchors, "part int, block int, once binary, more binary")
    shared = saved(packed.groupBy("part").applyInPandas(_shared, "block int, anchors binary"))
    # Places and hashes only: bytes are fetched where they are compared.
    found = saved(long_enough.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(_contexts, CONTEXT).select(
        "anchor", F.xxhash64("context").alias("key"), "node", "start", F.octet_length("context").alias("size")))
    dropped(shared)
    firsts = saved(found.groupBy("anchor", "key").agg(F.min(F.struct("node", "start", "size")).alias("at")).select(
        "anchor", "key", F.col("at.node").alias("first"), F.col("at.start").alias("first_start"), F.col("at.size").alias("size")))
    crowds = firsts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    # Each step is written before the next, so that the disks hold the shuffle of one at a time; steps that move texts or all
    # contexts take turns, so that they hold that of a part.
    asked = saved(firsts.join(crowds, "anchor").groupBy(F.col("first").alias("node")).agg(F.collect_list(F.struct(
        "anchor", "key", "n", F.col("first_start").alias("start"), "size")).alias("own")))
    mixed_ones = []
    for turn in range(TEXT_TURNS):
        mine = F.pmod(F.xxhash64("node"), F.lit(TEXT_TURNS)) == turn
        mixed_ones.append(saved(texts.select("node", "text").where(mine).join(asked.where(mine), "node").mapInPandas(
            _fetched, "anchor long, key long, n long, node long, context binary")))
    dropped(asked)
    fetched = reduce(DataFrame.union, mixed_ones)
    many = saved(fetched.where(F.col("n") > PAGE).select("anchor", "key", "node", "context"))
    small = saved(fetched.where(F.col("n") <= PAGE).select("anchor", "key", "node", "context").repartition(
        "anchor").sortWithinPartitions("anchor").mapInPandas(
        _scanned, "anchor long, key long, pieces array<struct<low:int,high:int>>"))
    dropped(*mixed_ones)
    strings = many.select("anchor", "key", "node", F.explode(F.transform(
        F.sequence(F.lit(0), F.octet_length("context") - LENGTH), lambda i: F.struct(
            i.alias("low"), F.xxhash64(F.substring("context", i + 1, F.lit(LENGTH))).alias("h1"),
            F.xxhash64(F.lit("second"), F.substring("context", i + 1, F.lit(LENGTH))).alias("h2")))).alias("s"))
    strings = strings.select("anchor", "key", "node", "s.*")
    earliest = saved(strings.groupBy("h1", "h2").agg(F.min("node").alias("earliest"), F.max("node").alias("latest")).where(
        "earliest < latest").select("h1", "h2", "earliest"))
    large = saved(strings.join(earliest, ["h1", "h2"]).where("node > earliest").groupBy("anchor", "key").agg(
        F.collect_set(F.struct("low", (F.col("low") + LENGTH).alias("high"))).alias("pieces")))
    dropped(many, earliest)
    spans = [saved(_placed(*(t.where(F.pmod("anchor", F.lit(TURNS)) == turn) for t in (
        found, firsts.select("anchor", "key", "first"), small.union(large))))) for turn in range(TURNS)]
    dropped(found, firsts, small, large)
    return reduce(DataFrame.union, spans)


def _placed(found: DataFrame, firsts: DataFrame, pieces: DataFrame) -> DataFrame:
    """``node, low, high``: contexts that an earlier document has whole, of others their ``pieces``."""
    at = found.join(firsts, ["anchor", "key"]).join(pieces, ["anchor", "key"], "left")
    whole = F.array(F.struct(F.lit(0).alias("low"), F.col("size").alias("high")))
    # The first document of a context may have it at several places.
    gone = at.select("node", "start", F.inline(F.when(F.col("node") > F.col("first"), whole).otherwise(F.col("pieces"))))
    return gone.select("node", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))


def _kept(text: str, spans) -> tuple[int, int, int, bytes]:
    """Bytes, bytes removed, runs removed, what is left."""
    raw = text.encode()
    runs: list[list[int]] = []
    for low, high in sorted((int(s["low"]), int(s["high"])) for s in spans):
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high)
        else:
            runs.append([low, high])
    kept, at = [], 0
    for low, high in runs:
        kept.append(raw[at:low])
        at = high
    return len(raw), sum(b - a for a, b in runs), len(runs), b"".join([*kept, raw[at:]])


def _results(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, text, spans, copy in zip(batch["doc_id"], batch["text"], batch["spans"], batch["copy"], strict=True):
            if copy:
                size = len(text.encode())
                spans = [{"low": 0, "high": size}] if size >= LENGTH else []
            size, gone, runs, kept = _kept(text, () if spans is None else spans)
            out.append((None if pd.isna(doc_id) else int(doc_id), size, gone, runs, kept))
        yield pd.DataFrame({k: pd.Series(v, dtype=t) for (k, t), v in zip(
            [("doc_id", "Int64"), ("n_bytes", "int64"), ("n_removed", "int64"), ("n_spans", "int64"), ("kept", object)],
            zip(*out, strict=True), strict=True)})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept``, the bytes that stay.

    A byte goes if a string of 50 bytes that covers it also starts in a document with a smaller ``doc_id``.

    Nulls: a null text is empty; a row with a null ``doc_id`` stays whole and takes nothing from others. Rows with the
    same id don't count as earlier than each other; if their texts differ, both count as that document for all others
    and spans found for that id go from the first of its texts only. Other columns are left out.
    """
    _, copies, texts = distinct_texts(docs)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = rows.select("doc_id", "text", *wide_key(F.col("text")))
    spans = settled(lambda: repeated_spans(texts).groupBy(F.col("node").alias("of")).agg(
        F.collect_set(F.struct("low", "high")).alias("spans")))
    marked = keyed.join(small_side(copies.withColumn("copy", F.lit(True))), ["doc_id", "h1", "h2"], "left").select(
        "doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"))
    joined = marked.join(spans, (marked["doc_id"] == F.col("of")) & ~marked["copy"], "left").select(
        "doc_id", "text", "spans", "copy")
    return joined.mapInPandas(_results, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
