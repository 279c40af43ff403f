"""Token ids of a corpus in files of their own format, one wavelet matrix a shard.

A shard holds the ids of consecutive documents. Its distinct ids are numbered, and the numbers' bits are laid out in
planes, the highest first; below each plane the tokens whose bit is 0 come before those whose bit is 1. With the count of
ones before every 512th place, one file answers without being decoded: the token at a place (``access``), how often a
token stands before a place (``rank``), and where it stands (``select``).

File, little-endian: ``b"WMX1"``, then as unsigned 64-bit numbers how many tokens, distinct ids and planes there are; the
distinct ids (32 bits each, ascending); for each plane the number of its zeros and of its compressed bytes (64 bits each)
and these bytes (deflate); its bits from the lowest of a byte on, filled up to whole bytes. The counts are made when a
file is opened.

Spark writes the files: each shard is one row in one Parquet file of a table, next to its documents' ids and lengths, so
that files appear by Spark's commits only and are read by whatever store Spark reads. Documents are dealt out by ranges of
their ids, so shards are ascending; a task cuts its range into shards and holds one at a time.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import small_side
from tidewater.llm.tokens import apart, laid_out, marked, together

MAGIC = b"WMX1"
#: Bits between two counts of ones.
STEP = 512
#: Ids below it are numbered by a table, others by sorting.
SMALL_IDS = 2**20
#: Tokens of a shard; a longer document is a shard of its own.
SHARD_TOKENS = 4_000_000
#: Characters dealt to a task, on average.
TASK_CHARS = 10_000_000
#: Characters encoded at a time; words, in each of two caches, and pieces of words a worker remembers.
CHUNK_CHARS, CACHED_WORDS, CACHED_PIECES = 8_000_000, 400_000, 800_000

SHARDS = "part int, nth int, n_tokens long, doc_ids array<long>, lengths array<long>, file binary"


class Plane:
    """Bits with counts of ones."""

    def __init__(self, bits: np.ndarray, n: int, zeros: int):
        self.bits, self.n, self.zeros = bits, n, zeros
        words = np.zeros((len(bits) + 63) // 64 * 64, np.uint8)
        words[:len(bits)] = bits
        self.words = words.view(np.uint64)
        ones = np.bitwise_count(self.words).reshape(-1, STEP // 64).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before the places ``at`` (0 to ``n``)."""
        block = at // STEP
        out = self.before[block]
        word, last = block * (STEP // 64), at >> 6
        for k in range(STEP // 64):
            out = out + np.where(word + k < last, np.bitwise_count(self.words[np.minimum(word + k, len(self.words) - 1)]), 0) \
                if len(self.words) else out
        rest = (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        if len(self.words):
            out = out + np.bitwise_count(self.words[np.minimum(last, len(self.words) - 1)] & mask)
        return out.astype(np.int64)

    def find(self, bit: bool, nth: np.ndarray) -> np.ndarray:
        """The places of the ``nth`` (from 0) ones or zeros, by bisection on the counts."""
        low, high = np.zeros_like(nth), np.full_like(nth, self.n)
        while (low < high).any():
            middle = (low + high) >> 1
            upto = self.ones(middle + 1)
            enough = (upto if bit else middle + 1 - upto) > nth
            live = low < high
            high = np.where(live & enough, middle, high)
            low = np.where(live & ~enough, middle + 1, low)
        return low


class WaveletMatrix:
    """A sequence of token ids as bit planes."""

    def __init__(self, n: int, known: np.ndarray, planes: list[Plane]):
        self.n, self.known, self.planes = n, known, planes

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        if len(ids) and int(ids.max()) < SMALL_IDS:
            met = np.bincount(ids) > 0
            known, codes = np.flatnonzero(met), (np.cumsum(met) - 1).astype(np.uint32)[ids]
        else:
            known, codes = np.unique(ids, return_inverse=True)
        depth = max(0, int(len(known) - 1).bit_length())
        codes = codes.astype(np.uint16 if depth <= 16 else np.uint32)
        planes = []
        for level in range(depth - 1, -1, -1):
            bit = (codes >> level & 1).astype(bool)
            upper = np.compress(bit, codes)
            planes.append(Plane(np.packbits(bit, bitorder="little"), len(ids), len(ids) - len(upper)))
            codes = np.concatenate([np.compress(~bit, codes), upper])
        return cls(len(ids), known.astype(np.uint32), planes)

    def to_bytes(self) -> bytes:
        out = [MAGIC, struct.pack("<QQQ", self.n, len(self.known), len(self.planes)), self.known.astype("<u4").tobytes()]
        for plane in self.planes:
            packed = zlib.compress(plane.bits.tobytes(), 1)
            out += [struct.pack("<QQ", plane.zeros, len(packed)), packed]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, file: bytes | memoryview) -> WaveletMatrix:
        file = memoryview(file)
        if bytes(file[:4]) != MAGIC:
            raise ValueError("not a file of token ids")
        n, distinct, depth = struct.unpack_from("<QQQ", file, 4)
        at = 28 + 4 * distinct
        known, planes = np.frombuffer(file[28:at], "<u4"), []
        for _ in range(depth):
            zeros, size = struct.unpack_from("<QQ", file, at)
            at += 16
            planes.append(Plane(np.frombuffer(zlib.decompress(file[at:at + size]), np.uint8), n, zeros))
            at += size
        return cls(n, known, planes)

    def ids(self) -> np.ndarray:
        """All ids, from the last plane to the first."""
        codes = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level, plane in enumerate(reversed(self.planes)):
            bit = np.unpackbits(plane.bits, count=self.n, bitorder="little").astype(bool)
            above = np.empty_like(codes)
            above[~bit] = codes[:plane.zeros]
            above[bit] = codes[plane.zeros:] | codes.dtype.type(1 << level)
            codes = above
        return self.known[codes] if self.n else np.zeros(0, np.uint32)

    def access(self, places: Iterable[int]) -> np.ndarray:
        """The ids at ``places``."""
        at = np.asarray(places, np.int64)
        code = np.zeros(len(at), np.int64)
        for plane in self.planes:
            bit, ones = plane.get(at), plane.ones(at)
            at = np.where(bit, plane.zeros + ones, at - ones)
            code = code << 1 | bit
        return self.known[code]

    def _code(self, token: int) -> int | None:
        at = int(np.searchsorted(self.known, token))
        return at if at < len(self.known) and self.known[at] == token else None

    def _path(self, code: int) -> list[tuple[Plane, bool]]:
        depth = len(self.planes)
        return [(plane, bool(code >> depth - 1 - k & 1)) for k, plane in enumerate(self.planes)]

    def rank(self, token: int, place: int) -> int:
        """How often ``token`` stands before ``place``."""
        code = self._code(token)
        if code is None:
            return 0
        ends = np.array([0, min(max(place, 0), self.n)], np.int64)
        for plane, bit in self._path(code):
            ones = plane.ones(ends)
            ends = plane.zeros + ones if bit else ends - ones
        return int(ends[1] - ends[0])

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, nth: Iterable[int] | None = None) -> np.ndarray:
        """The places of ``token``: its ``nth`` ones (from 0), or all."""
        n = self.count(token)
        asked = np.arange(n) if nth is None else np.asarray(nth, np.int64)
        if len(asked) and (asked.min() < 0 or asked.max() >= n):
            raise IndexError(f"token {token} stands {n} times here")
        if not len(asked):
            return asked.astype(np.int64)
        code = self._code(token)
        path, begin = self._path(code), np.zeros(1, np.int64)
        for plane, bit in path:
            ones = plane.ones(begin)
            begin = plane.zeros + ones if bit else begin - ones
        at = begin + asked
        for plane, bit in reversed(path):
            at = plane.find(bit, at - plane.zeros if bit else at)
        return at


class WordEncoder:
    """Ids of texts by a lower-casing tokenizer whose words never cross a space or line end.

    Words are cut at spaces and remembered. A new word of plain Latin letters, digits and signs is cut as the tokenizer cuts
    it, so its pieces can be looked up as well; any other word is encoded as it is. New pieces of letters are encoded many in a
    text: only a piece's last token ends it.
    """

    #: Fixed values of the tokenizer: how it cuts lower-cased words, here for ``PLAIN`` ones.
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")
    SPECIAL = "<|"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.ends = marked(self.tokenizer, lambda token: token.endswith("</w>"))

    def _pieces_of(self, word: str) -> list[str]:
        if word.isascii() and word.isalpha():
            return [word.lower()]
        return self.PIECES.findall(word.lower()) if self.PLAIN.fullmatch(word) and self.SPECIAL not in word else [word]

    def _learn(self, words: list[str]) -> None:
        if len(self.pieces) > CACHED_PIECES:
            self.pieces = {}
        plans = list(map(self._pieces_of, words))
        pieces = self.pieces
        fresh = list(set(chain.from_iterable(plans)).difference(pieces))
        alone = [p for p in fresh if not (p.isascii() and p.isalpha() and p.islower())]
        joined = list(set(fresh).difference(alone))
        pieces.update(zip(joined, together(self.tokenizer, joined, " ", self.ends, True), strict=True))
        pieces.update(zip(alone, apart(self.tokenizer, alone), strict=True))
        self.words.update((w, pieces[plan[0]] if len(plan) == 1 else b"".join([pieces[p] for p in plan]))
                          for w, plan in zip(words, plans, strict=True))

    def _known(self, words: list[str]) -> list[bytes]:
        """The ids of different ``words``. A full cache is kept until the next one is full: words met again move there."""
        if len(self.words) > CACHED_WORDS:
            self.words, self.older = {}, self.words
        new = [w for w in words if w not in self.words]
        self.words.update((w, self.older[w]) for w in new if w in self.older)
        self._learn([w for w in new if w not in self.words])
        return list(map(self.words.__getitem__, words))

    def batch(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian unsigned 32-bit ids. Arrow cuts the texts and numbers their words: each is looked up once.

        Letters of ASCII in lower case, and a comma or full stop behind one and before a space apart, give the same ids from
        fewer different words; not where a text may have special tokens, which are met as they are written.
        """
        flat = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " ")
        if not pc.any(pc.match_substring(flat, self.SPECIAL)).as_py():
            flat = pc.replace_substring_regex(pc.ascii_lower(flat), "([a-z])([,.]) ", "\\1 \\2 ")
        cut = pc.split_pattern(flat, " ")
        coded = cut.values.dictionary_encode()
        own = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        return laid_out(own, coded.indices.to_numpy(), cut.offsets.to_numpy())


_encoders: dict[str, WordEncoder] = {}


def _writer(path: str, end_id: int, shard_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _encoders:
            _encoders[path] = WordEncoder(path)
        encode, closing = _encoders[path], end_id.to_bytes(4, "little")
        part, nth = TaskContext.get().partitionId(), 0
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def shard() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(ids for _, ids in held), "<u4")
            columns = [pa.array([part], pa.int32()), pa.array([nth], pa.int32()), pa.array([len(ids)], pa.int64()),
                       pa.array([[i for i, _ in held]], pa.list_(pa.int64())),
                       pa.array([[len(ids) // 4 for _, ids in held]], pa.list_(pa.int64())),
                       pa.array([WaveletMatrix.of(ids).to_bytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(
                columns, ["part", "nth", "n_tokens", "doc_ids", "lengths", "file"])

        for doc_ids, texts in _chunks(batches):
            for doc_id, packed in zip(doc_ids, encode.batch(texts), strict=True):
                own = packed + closing
                if held and size + len(own) // 4 > shard_tokens:
                    yield shard()
                    nth, size = nth + 1, 0
                    held.clear()
                held.append((doc_id, own))
                size += len(own) // 4
        if held:
            yield shard()

    return write


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of some ``CHUNK_CHARS`` characters; a longer text comes alone."""
    ids, texts, chars = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids.append(doc_id)
            texts.append(text.as_py() or "")
            chars += len(texts[-1])
            if chars >= CHUNK_CHARS:
                yield ids, texts
                ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1,
                 shard_tokens: int = SHARD_TOKENS, task_chars: int = TASK_CHARS) -> None:
    """Writes the ids of every text of ``docs`` (``doc_id``, ``text``), each with ``end_id`` behind it, to ``folder``.

    Documents are in ascending order of ``doc_id``, those with a null id first, equal ids by a hash of their texts. The
    tokenizer must be one whose words end at spaces and line ends.

    Nulls: a null text is empty, so only ``end_id`` is written. Repeated rows are written each for itself. A text of any
    length is one document; one with more tokens than ``shard_tokens`` has a shard to itself. No documents give no file.
    Other columns are left out, whatever their names.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    chars = rows.agg(F.sum(F.char_length("text").cast("long"))).first()[0] or 0
    # Many rows with one id, or none, are dealt out by their texts and then by where they stand.
    ranges = rows.withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id()).repartitionByRange(
        1 + chars // task_chars, "doc_id", "h", "row")
    ordered = ranges.sortWithinPartitions("doc_id", "h", "row").select("doc_id", "text")
    shards = ordered.mapInArrow(_writer(tokenizer_path, end_id, shard_tokens), SHARDS)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(folder)


def read_shards(spark, folder: str) -> DataFrame:
    """The shards with ``first``, the number of tokens in the shards before."""
    shards = spark.read.schema(SHARDS).parquet(folder)
    # A row for each file: its place and size.
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    firsts = shards.select("part", "nth", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first"))
    return shards.join(small_side(firsts), ["part", "nth"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            ids = WaveletMatrix.from_bytes(batch.column("file")[k].as_buffer()).ids().astype("<u4").tobytes()
            ends = np.concatenate([[0], np.cumsum(batch.column("lengths")[k].values.to_numpy())]).astype(np.int64)
            own = [ids[4 * a:4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            starts = pa.array(ends[:-1] + batch.column("first")[k].as_py())
            # Half a million tokens at a time go on.
            low, size = 0, 0
            for at, packed in enumerate(own, 1):
                size += len(packed)
                if size > 2_000_000 or at == len(own):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_ids")[k].values[low:at], starts[low:at], pa.array(own[low:at], pa.binary())],
                        ["doc_id", "start", "ids"])
                    low, size = at, 0


def read_documents(spark, folder: str) -> DataFrame:
    """``doc_id, start, ids`` of every document in a folder of shards.

    ``start`` counts the tokens of all documents before, ``ids`` are its tokens as packed little-endian unsigned 32-bit
    numbers. A folder without files gives no rows.
    """
    return read_shards(spark, folder).select("doc_ids", "lengths", "file", "first").mapInArrow(
        _read, "doc_id long, start long, ids binary")


def token_counts(spark, folder: str, tokens: list[int]) -> DataFrame:
    """``token, n``: how often each of ``tokens`` stands in the corpus, by rank in each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(tokens), np.int64)
        for batch in batches:
            for file in batch.column("file"):
                shard = WaveletMatrix.from_bytes(file.as_buffer())
                n += [shard.count(t) for t in tokens]
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(n)], ["token", "n"])

    shards = spark.read.schema(SHARDS).parquet(folder)
    return shards.select("file").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(spark, folder: str, token: int) -> DataFrame:
    """``doc_id, place, position``: where ``token`` stands in its document and in the corpus, by select in each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                at = WaveletMatrix.from_bytes(batch.column("file")[k].as_buffer()).select(token)
                begin = np.concatenate([[0], np.cumsum(batch.column("lengths")[k].values.to_numpy())]).astype(np.int64)
                doc = np.searchsorted(begin, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[k].values.take(pa.array(doc)), pa.array(at - begin[doc]),
                     pa.array(at + batch.column("first")[k].as_py())], ["doc_id", "place", "position"])

    return read_shards(spark, folder).select("doc_ids", "lengths", "file", "first").mapInArrow(
        run, "doc_id long, place long, position long")
