"""Encoding texts in the pieces of a SentencePiece model, and decoding them, by best paths through lattices.

A space is ``▁`` and a text starts with one. No piece goes over the start of a run of ``▁`` or over a line end, so a text is
encoded unit by unit, and each distinct unit once for a block of text. All units of a block share the steps of one Viterbi:
the edges are the substrings that are pieces, found by their hashes; each step takes the edges that end at the next place of
every unit and keeps the best score and its last edge. A character that is no piece is an edge with a score below all others
and becomes the pieces of its UTF-8 bytes. Of equal scores the one whose last piece is longer wins. Texts are not shuffled.

The best path is the one with the greatest sum of the model's scores, whatever the model was trained for: for a model of
merges, the library's own encoder merges greedily and may cut a word in other places. Decoding gives the text back either way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
#: Below the lowest score by so much is the score of a character that is no piece.
PENALTY = 10.0
UNIT = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
#: Text whose distinct units are encoded at once; if all are distinct, that takes some 250 bytes for each of the text.
BLOCK_BYTES = 1_500_000


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    """``piece, id, score`` of the pieces that match text; as many as the model file has."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    rows = [(model.id_to_piece(i), i, model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return spark.createDataFrame(rows, "piece string, id int, score double")


def _byte_ids(path: str) -> list[int]:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


class Lattice:
    """The pieces of a model by their hashes, and the best paths of many units at once.

    Each place of all units is a step's row: the substrings that end there are looked up longest first by a rolling hash and
    compared with the piece's characters, so a chance equality of hashes changes nothing.
    """

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, rows: list[tuple[str, int, float]], lowest: float):
        self.longest = max(len(piece) for piece, _, _ in rows)
        self.other = lowest - PENALTY
        self.by_length = {}
        for n in sorted({len(piece) for piece, _, _ in rows}):
            own = [r for r in rows if len(r[0]) == n]
            chars = _codes("".join(piece for piece, _, _ in own)).reshape(-1, n)
            hashes = self._hashes(chars.ravel(), n)[::n]
            order = np.argsort(hashes)
            some = np.zeros(1 << 20, bool)  # of most substrings the first bits of the hash say that they are no piece
            some[hashes >> np.uint64(44)] = True
            self.by_length[n] = (some, hashes[order], chars[order], np.array([i for _, i, _ in own], np.int32)[order],
                                 np.array([s for _, _, s in own], np.float64)[order])

    def _hashes(self, codes: np.ndarray, n: int) -> np.ndarray:
        """A hash of the ``n`` characters from each place on; places too near the end are left out."""
        out = np.zeros(len(codes) - n + 1, np.uint64)
        for k in range(n):
            out = (out + codes[k: len(codes) - n + 1 + k].astype(np.uint64) + np.uint64(1)) * self.FACTOR
            out ^= out >> np.uint64(29)
        return out

    def _found(self, codes: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """``n, low, ids, scores`` of the pieces of ``n`` characters at the places ``low``; ``left`` are a unit's from a place on."""
        hashes = np.zeros(len(codes), np.uint64)
        for n in range(1, self.longest + 1):
            hashes = hashes[: len(codes) - n + 1]
            if not len(hashes):
                return
            hashes = (hashes + codes[n - 1:].astype(np.uint64) + np.uint64(1)) * self.FACTOR
            hashes ^= hashes >> np.uint64(29)
            if n not in self.by_length:
                continue
            some, known, chars, ids, scores = self.by_length[n]
            low = np.flatnonzero((left[: len(hashes)] >= n) & some[hashes >> np.uint64(44)])
            at = np.minimum(np.searchsorted(known, hashes[low]), len(known) - 1)
            hit = known[at] == hashes[low]
            low, at = low[hit], at[hit]
            same = (codes[low[:, None] + np.arange(n)] == chars[at]).all(axis=1)
            yield n, low[same], ids[at[same]], scores[at[same]]

    def paths(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the best paths of ``units``, one after the other, and how many each has; a character that is no piece is
        -1 minus its code."""
        codes, sizes = _codes("".join(units)), np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(sizes)
        begins = ends - sizes
        place = np.arange(len(codes)) - np.repeat(begins, sizes)
        left = np.repeat(sizes, sizes) - place
        edges = [(np.full(len(codes), 1, np.int8), np.arange(len(codes)), -1 - codes.astype(np.int32), np.full(len(codes), self.other))]
        for n, low, ids, scores in self._found(codes, left):
            if n == 1:  # the piece of a character stands for it
                edges[0][2][low], edges[0][3][low] = ids, scores
            else:
                edges.append((np.full(len(low), n, np.int8), low, ids, scores))
        lengths, low, ids, scores = (np.concatenate(x) for x in zip(*edges, strict=True))
        # Edges by the place they end at in their unit: a step takes the next place of all units. Longer pieces stay last, and
        # win among equal scores.
        high = low + lengths
        order = np.argsort(place[high - 1] * (len(codes) + 1) + high, kind="stable")
        lengths, low, high, ids, scores = lengths[order], low[order], high[order], ids[order], scores[order]
        starts_unit = place[low] == 0
        best, own = np.full(len(codes) + 1, -np.inf), np.zeros(len(codes) + 1, np.int64)
        cuts = np.append(np.flatnonzero(np.diff(place[high - 1], prepend=-1)), len(high)).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            # ``best`` of a place is that of the way to its last character; a unit's first place has none before it.
            total = np.where(starts_unit[a:b], 0.0, best[low[a:b] - 1]) + scores[a:b]
            last = high[a:b] - 1
            group = np.flatnonzero(np.diff(last, prepend=-1))
            most = np.maximum.reduceat(total, group)
            best[last[group]] = most
            won = np.flatnonzero(total == np.repeat(most, np.diff(np.append(group, b - a))))
            own[last[won]] = a + won  # the last of equal ones, the longest, stays
        # Back from the ends: a step takes the last piece of all units that are not done.
        taken = np.zeros(len(codes), bool)
        at, begin = (ends - 1)[sizes > 0], begins[sizes > 0]
        while len(at):
            taken[at] = True
            at = low[own[at]] - 1
            on = at >= begin
            at, begin = at[on], begin[on]
        lasts = np.flatnonzero(taken)
        return ids[own[lasts]], np.diff(np.append(0, np.cumsum(taken))[np.append(0, ends)])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def units_of(text: str) -> list[str]:
    return UNIT.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _with_bytes(ids: np.ndarray, counts: np.ndarray, byte_ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` of some units, ``counts`` of each, with the pieces of its bytes for each character that is no piece."""
    odd = np.flatnonzero(ids < 0)
    if not len(odd):
        return ids, counts
    spelled = [[byte_ids[b] for b in chr(-1 - c).encode()] for c in ids[odd].tolist()]
    sizes = np.ones(len(ids), np.int64)
    sizes[odd] = list(map(len, spelled))
    out = np.repeat(ids, sizes)
    ends = np.append(0, np.cumsum(sizes))
    for k, own in zip(odd.tolist(), spelled, strict=True):
        out[ends[k]: ends[k + 1]] = own
    return out, np.diff(ends[np.append(0, np.cumsum(counts))])


def _encoder(lattice: Broadcast, byte_ids: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                cut = list(map(units_of, part.column("text").to_pylist()))
                counts = list(map(len, cut))
                units = pa.array(chain.from_iterable(cut), pa.large_string()).dictionary_encode()
                distinct = units.dictionary.to_numpy(zero_copy_only=False).tolist()
                ids, sizes = _with_bytes(*lattice.value.paths(distinct), byte_ids)
                places = units.indices.to_numpy()
                each = sizes[places]
                ends = np.append(0, np.cumsum(each))
                flat = ids[np.arange(ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[places] - ends[:-1], each)]
                offsets = ends[np.append(0, np.cumsum(counts))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))], ["doc_id", "ids"])

    return run


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Some rows of ``batch`` at a time, of ``BLOCK_BYTES`` of text or one row."""
    sizes = np.asarray(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), np.int64)
    low, size = 0, 0
    for k, own in enumerate(sizes.tolist()):
        if k > low and size + own > BLOCK_BYTES:
            yield batch.slice(low, k - low)
            low, size = k, 0
        size += own
    if low < batch.num_rows:
        yield batch.slice(low)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, ids`` for each row of ``docs`` (``doc_id``, ``text``).

    Nulls: a null text is empty and has no ids; a null ``doc_id`` stays null. Repeated rows give repeated results, an empty
    table none; other columns are left out. A very long text, and a text without any space, is encoded whole.
    """
    spark = docs.sparkSession
    pieces = piece_table(spark, model_path)
    known = [(r["piece"], r["id"], r["score"]) for r in pieces.collect()]  # as many as the model has, whatever the corpus
    lattice = spark.sparkContext.broadcast(Lattice(known, min(score for _, _, score in known)))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_encoder(lattice, _byte_ids(model_path)), "doc_id long, ids array<int>")


def decode(rows: DataFrame, model_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with the text of their ``ids`` in the column ``text``; of null, null. ``▁`` comes back as a space.

    A column of that name that ``rows`` already has is replaced.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    spelled = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i)
               else model.id_to_piece(i).replace(SPACE, " ").encode() for i in range(model.get_piece_size())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(spelled, pa.large_binary())
        for batch in batches:
            lists = batch.column(ids)
            flat = table.take(lists.values)
            raw = flat.buffers()[2].to_pybytes() if len(flat) and flat.buffers()[2] else b""
            sizes = np.frombuffer(flat.buffers()[1], np.int64) if len(flat) else np.zeros(1, np.int64)
            ends = sizes[lists.offsets.to_numpy()].tolist()
            texts = [raw[a:b].decode(errors="replace").removeprefix(" ") if there else None
                     for a, b, there in zip(ends[:-1], ends[1:], lists.is_valid().to_pylist(), strict=True)]
            kept = [n for n in batch.schema.names if n != text]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(texts, pa.string())], [*kept, text])

    rows = rows.drop(text) if text != ids else rows
    schema = T.StructType([*[f for f in rows.schema.fields if f.name != text], T.StructField(text, T.StringType())])
    return rows.mapInArrow(run, schema)
