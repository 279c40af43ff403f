"""Near-duplicate documents: ProbMinHash signatures of weighted word shingles, banding and exact verification.

Similarity is the probability Jaccard of the shingles' counts. A signature has one component for each of ``BANDS *
BAND_ROWS`` registers. Every distinct shingle of a text is a Poisson process whose rate is its count: arrivals fall on
random registers, a register keeps the earliest, and a shingle's process ends as soon as it is later than all registers.
Two texts agree in a register with a probability equal to their similarity.

Texts that agree in a whole band are candidates, whatever the size of the band's group; at a similarity of 0.8 the 25 bands
of 5 find 99.995 % of pairs. Groups of up to ``PAGE`` texts give all their pairs, larger ones are compared with pivots in
rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import distinct_texts, dropped, saved, settled, small_side, word_hashes
from tidewater.llm.components import components, pivot_links, sized, small_pairs

SHINGLE, SIMILARITY = 5, 0.8
BANDS, BAND_ROWS = 25, 5
#: Numbers of 64 bits in a sketch: fewer are full before texts of some hundred shingles are told apart.
SKETCH = 16


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, lengths: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` words of each text, and the text of each; a shorter text is one run.

    ``hashes`` has the words' hashes of all texts one after the other, ``lengths`` their numbers.
    """
    doc = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    left = ends - np.arange(len(hashes))  # words from here to the text's end
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    total = np.zeros(len(hashes), np.uint64)
    for k in range(n):  # the step wraps around at 64 bits
        part = mixed(padded[k: k + len(hashes)] + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF))
        total = total * np.uint64(0x100000001B3) + np.where(left > k, part, np.uint64(0))
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    use = (left >= n) | (np.arange(len(hashes)) == starts) & (ends - starts < n)
    return mixed(total[use]), doc[use]


def weighted(shingles: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hash, text, count."""
    order = np.lexsort((shingles, doc))
    shingles, doc = shingles[order], doc[order]
    first = np.ones(len(doc), bool)
    first[1:] = (shingles[1:] != shingles[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    return shingles[at], doc[at], np.diff(np.append(at, len(doc)))


def signatures(shingles: np.ndarray, doc: np.ndarray, weight: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """``docs x registers``: the shingle that came first to each register; 0 for texts without shingles."""
    earliest = np.full(docs * registers, np.inf)
    winner = np.zeros(docs * registers, np.uint64)
    at, state, turn = np.zeros(len(shingles)), shingles, 0
    while len(state):
        turn += 1
        seed = mixed(state + np.uint64(0x9E3779B97F4A7C15 * turn & 0xFFFFFFFFFFFFFFFF))
        at = at - np.log1p(-(seed >> np.uint64(11)).astype(np.float64) * 2.0**-53) / weight
        slot = doc * registers + (mixed(seed + np.uint64(0xD1B54A32D192ED03)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, slot, at)
        won = at == earliest[slot]
        winner[slot[won]] = state[won]
        live = np.zeros(docs, bool)
        live[doc] = True
        some = np.flatnonzero(live)
        latest = np.zeros(docs)
        latest[some] = earliest.reshape(docs, registers)[some].max(axis=1)
        go_on = at < latest[doc]
        at, state, doc, weight = at[go_on], state[go_on], doc[go_on], weight[go_on]
    return winner.reshape(docs, registers)


def probability_jaccard(x: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray) -> float:
    """The probability Jaccard of two bags: distinct shingles ``x`` and ``y`` in order, with their counts."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    keys = np.concatenate([x, y])
    order = np.argsort(keys, kind="stable")
    twice = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    i, j = order[twice], order[twice + 1] - len(x)  # places of the common shingles in x and in y
    if n.max() == 1 and m.max() == 1:
        return len(i) / (len(x) + len(y) - len(i))
    p, q = n[i].astype(np.float64), m[j].astype(np.float64)
    only_p, only_q = n.sum() - p.sum(), m.sum() - q.sum()
    by_ratio = np.argsort(p / q, kind="stable")
    p, q = p[by_ratio], q[by_ratio]
    first = np.searchsorted(p / q, p / q, side="left")
    # For a shingle of ratio r: those of ratio r or more count by p, the others by q.
    above = np.append(np.cumsum(p[::-1])[::-1], 0.0)[first] + only_p
    below = np.append(0.0, np.cumsum(q))[first] + only_q
    return float(np.sum(1 / (above / p + below / q)))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return (lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64),
            np.diff(lists.offsets.to_numpy()).astype(np.int64))


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 2000):
            part = batch.slice(low, 2000)
            hashes, lengths = _flat(part.column("w"))
            shingles, doc, weight = weighted(*shingle_hashes(hashes, lengths))
            won = signatures(shingles, doc, weight, len(lengths), BANDS * BAND_ROWS).reshape(-1, BANDS, BAND_ROWS)
            keys = np.zeros(won.shape[:2], np.uint64)
            for k in range(BAND_ROWS):
                keys = mixed(keys + won[:, :, k] + np.uint64(k + 1))
            keys = keys >> np.uint64(8) | np.arange(BANDS, dtype=np.uint64) << np.uint64(56)
            some = lengths > 0
            yield pa.RecordBatch.from_arrays([
                part.column("node").filter(pa.array(some)),
                pa.FixedSizeListArray.from_arrays(pa.array(keys[some].view(np.int64).ravel()), BANDS).cast(
                    pa.list_(pa.int64()))], ["node", "bands"])


def sketches(shingles: np.ndarray, weight: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text ``64 * SKETCH`` bits in numbers, one of which each distinct shingle turns over, the number of shingles,
    and whether some occur more than once."""
    docs = len(offsets) - 1
    bits = np.zeros(docs * SKETCH, np.uint64)
    place = np.repeat(np.arange(docs) * SKETCH, np.diff(offsets)) + (shingles % np.uint64(SKETCH)).astype(np.int64)
    np.bitwise_xor.at(bits, place, np.uint64(1) << (shingles // np.uint64(SKETCH) & np.uint64(63)))
    total = np.diff(np.append(0, np.cumsum(weight))[offsets]).astype(np.int64)
    return np.column_stack([bits.view(np.int64).reshape(docs, SKETCH), total, total > np.diff(offsets)])


def may_be_similar(x: Column, y: Column) -> Column:
    """False only for texts whose ``sketches`` exclude it, as more distinct shingles are in one of them only than may be.

    Of ``n`` and ``m`` shingles let shares ``p`` and ``q`` be of those that the other text has not. The probability Jaccard is
    at most ``(1 - p) (1 - q) / (1 - p q)``: its terms, harmonic in the shares of a common shingle, are concave, so together at
    most one term of their sums. Of all ``p`` and ``q`` that leave ``SIMILARITY``, ``p n + q m`` is the greatest where it is
    ``(n + m - 2 SIMILARITY sqrt(n m)) / (1 + SIMILARITY)``. Texts without repeated shingles have the plain Jaccard similarity,
    so at most ``(n + m) (1 - SIMILARITY) / (1 + SIMILARITY)`` are in one only.
    """
    differ = sum((F.bit_count(F.get(x, k).bitwiseXOR(F.get(y, k))) for k in range(SKETCH)), F.lit(0))
    n, m = F.get(x, SKETCH), F.get(y, SKETCH)
    both = F.when((F.get(x, SKETCH + 1) == 0) & (F.get(y, SKETCH + 1) == 0), (n + m) * (1 - SIMILARITY)).otherwise(
        n + m - F.sqrt(n * m) * (2 * SIMILARITY))
    return differ <= both / (1 + SIMILARITY) + 1e-6


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct shingles of each text in order, their counts and their sketch."""
    for batch in batches:
        for low in range(0, batch.num_rows, 2000):
            part = batch.slice(low, 2000)
            hashes, lengths = _flat(part.column("w"))
            shingles, doc, weight = weighted(*shingle_hashes(hashes, lengths))
            ends = np.searchsorted(doc, np.arange(len(lengths) + 1)).astype(np.int32)
            offsets, sketch = pa.array(ends), sketches(shingles, weight, ends)
            yield pa.RecordBatch.from_arrays([
                part.column("node"), pa.ListArray.from_arrays(offsets, pa.array(shingles.view(np.int64))),
                pa.ListArray.from_arrays(offsets, pa.array(weight.astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(np.arange(len(sketch) + 1, dtype=np.int32) * (SKETCH + 2)), pa.array(sketch.ravel()))],
                ["node", "s", "k", "sketch"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that are alike, read from the batch in place: a batch is bounded in bytes, and nothing of it is copied."""
    for batch in batches:
        s, k, cuts = {}, {}, {}
        for x in "ab":
            shingles, counts = batch.column(f"s{x}"), batch.column(f"k{x}")
            cuts[x] = shingles.offsets.to_numpy()
            s[x] = shingles.values.to_numpy().view(np.uint64)
            k[x] = counts.values.to_numpy()
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            (la, ha), (lb, hb) = cuts["a"][i:i + 2], cuts["b"][i:i + 2]
            keep[i] = probability_jaccard(s["a"][la:ha], k["a"][la:ha], s["b"][lb:hb], k["b"][lb:hb]) >= SIMILARITY
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    left, right = (bags.select(F.col("node").alias(x), F.col("s").alias(f"s{x}"), F.col("k").alias(f"k{x}")) for x in "ab")
    return saved(pairs.join(left, "a").join(right, "b").select(
        "a", "b", "sa", "ka", "sb", "kb").mapInArrow(_similar, "a long, b long"))


def near_duplicate_links(texts: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between texts ``(node, text)`` that connect all similar ones."""
    bands = saved(word_hashes(texts).mapInArrow(_band_keys, "node long, bands array<long>"))
    members = sized(bands.select(F.explode("bands").alias("group"), "node"))
    dropped(bands)
    candidates = small_side(saved(members.select("node").distinct()))
    near = saved(word_hashes(texts.join(candidates, "node", "left_semi")).mapInArrow(
        _bags, "node long, s array<long>, k array<int>, sketch array<long>").dropDuplicates(["node"]))
    links = _verified(small_pairs(members), near)
    return pivot_links(members, links, lambda pairs: _verified(pairs, near), near.select("node", "sketch"), may_be_similar)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id``: for each distinct ``doc_id`` of ``docs`` the smallest id of its near-duplicates.

    Texts are alike from a probability Jaccard of 0.8 on over runs of five words; a text of fewer words is one run. Equal
    texts are always one class, so texts without words are only with their equals. Classes are connected groups.

    Nulls: a null text is empty; rows with a null ``doc_id`` are left out. Rows with the same id are one document, even
    if their texts differ. An empty table gives no rows; other columns are left out.
    """
    return settled(lambda: _classes(docs))


def _classes(docs: DataFrame) -> DataFrame:
    ids, copies, texts = distinct_texts(docs)
    exact = copies.select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    links = near_duplicate_links(texts)
    roots = components(links.select("a", "b").union(exact))
    ids = ids.select("doc_id").distinct()
    return ids.join(roots, ids["doc_id"] == roots["node"], "left").select(
        "doc_id", F.coalesce("root", "doc_id").alias("class_id"))


def first_of_class(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class; equal rows once, rows with a null id all."""
    drop = near_duplicates(docs).where("doc_id <> class_id").select(F.col("doc_id").alias("near_duplicate__id"))
    kept = docs.join(drop, docs["doc_id"] == F.col("near_duplicate__id"), "left_anti")
    return kept.dropDuplicates()
