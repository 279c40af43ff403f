"""Scores of texts by a log-bilinear language model trained with noise-contrastive estimation.

Words are counted over all training texts. The ``TOP`` most frequent tokens are classes of their own, other words fall in
``TAILS`` classes by their last two bytes. The model predicts the class of a token from the classes of the two before:
the sum of their vectors, each times the matrix of its place, gives a vector whose products with all classes' vectors,
plus their biases, are normalised over all classes. Within a class a token has its share of the class by counts, add-one,
with a share for unknown words. So the probabilities of all known tokens and the unknown one add up to 1.

Texts are cut into tokens once: a block of documents is written as one row, its tokens as places in its own words, which
training and scoring read. Training passes over all training texts: each partition starts from the same parameters, learns from its own tokens with
noise drawn from the class counts, and the parameters are averaged by tokens. Counts are summed by parts of the
vocabulary and sent back to the blocks of documents that need them, so nothing holds the whole vocabulary.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import saved

TOP, TAILS, SIZE = 192, 64, 24
NOISE, STEP, CHUNK, EPOCHS = 96, 0.08, 4096, 2
CLASSES = TOP + TAILS
BLOCK_BYTES, PARTS = 12_000_000, 64
#: The token that ends a text; no word is empty.
END = b""
SHAPES = {"vectors": (CLASSES, SIZE), "places": (2, SIZE, SIZE), "bias": (CLASSES,)}


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, and the end."""
    return [*(text or "").encode().lower().split(), END]


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _coded(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    """The block in one row: its documents, its words in order, and its tokens as places in the words."""
    place: dict[bytes, int] = {}
    docs = [np.fromiter([place.setdefault(w, len(place)) for w in own], np.int32, len(own)) for own in map(tokens, block["text"])]
    flat, lengths = np.concatenate(docs), np.array([len(d) for d in docs], np.int32)
    counts = np.bincount(flat[np.repeat(~block["held_out"].to_numpy(), lengths)], minlength=len(place))
    return pd.DataFrame([{
        "block": key[0], "ids": block["doc_id"].astype(object).where(block["doc_id"].notna(), None).tolist(),
        "held_out": block["held_out"].tolist(), "lengths": lengths.tobytes(), "places": flat.tobytes(),
        "words": b"\n".join(place), "counts": counts.astype(np.int64).tobytes()}])


def _dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of blocks by part of the vocabulary, with their places and their counts in the block's training texts."""
    for batch in batches:
        for r in batch.itertuples():
            own, counts = r.words.split(b"\n"), np.frombuffer(r.counts, np.int64)
            part = np.fromiter((zlib.crc32(w) % PARTS for w in own), np.int64, len(own))
            order = np.argsort(part, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                yield pd.DataFrame([(part[at[0]], r.block, b"\n".join(own[i] for i in at), at.astype(np.int32).tobytes(),
                                     counts[at].tobytes())], columns=["part", "block", "words", "places", "counts"])


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    """The counts of all texts for each block's words; then, as block -1, all words of the part with theirs."""
    total: Counter = Counter()
    split = [r.words.split(b"\n") for r in rows.itertuples()]
    for r, own in zip(rows.itertuples(), split, strict=True):
        for w, n in zip(own, np.frombuffer(r.counts, np.int64).tolist(), strict=True):
            total[w] += n
    known = {w: n for w, n in total.items() if n}
    out = [(b, None, p, np.array([total[w] for w in own], np.int64).tobytes(), None, 0)
           for b, p, own in zip(rows["block"], rows["places"], split, strict=True)]
    best = sorted(known.items(), key=lambda x: (-x[1], x[0]))[:TOP]
    tails = np.zeros((TAILS, 2), np.int64)
    for w, n in known.items():
        tails[zlib.crc32(w[-2:]) % TAILS] += (n, 1)
    out.append((-1, b"\n".join(w for w, _ in best), None, np.array([n for _, n in best], np.int64).tobytes(),
                tails.tobytes(), len(known)))
    return pd.DataFrame(out, columns=["block", "words", "places", "counts", "tails", "known"])


class Vocabulary:
    """Classes and totals; at most ``TOP`` words."""

    def __init__(self, rows: list):
        best = [(w, n) for r in rows if r["known"] for w, n in zip(
            bytes(r["words"]).split(b"\n"), np.frombuffer(bytes(r["counts"]), np.int64).tolist(), strict=True)]
        best = sorted(best, key=lambda x: (-x[1], x[0]))[:TOP]
        tails = sum((np.frombuffer(bytes(r["tails"]), np.int64).reshape(TAILS, 2) for r in rows), np.zeros((TAILS, 2), np.int64))
        for w, n in best:
            tails[zlib.crc32(w[-2:]) % TAILS] -= (n, 1)
        self.top = {w: i for i, (w, _) in enumerate(best)}
        self.totals = np.concatenate([[n for _, n in best], np.zeros(TOP - len(best)), tails[:, 0]]).astype(np.int64)
        self.words, self.n = sum(r["known"] for r in rows), int(self.totals.sum())
        self.within = np.log10(np.maximum(1, tails.sum(axis=1) + 1).astype(np.float64))  # of a tail: counts, words, unknown
        self.tail = [TOP + t for t in range(TAILS)]

    @classmethod
    def restored(cls, state: dict) -> Vocabulary:
        """The vocabulary with these attributes: broadcasts carry plain values only."""
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def classes(self, own: list[bytes]) -> np.ndarray:
        top, crc = self.top, zlib.crc32
        return np.fromiter([top[w] if w in top else TOP + crc(w[-2:]) % TAILS for w in own], np.int64, len(own))


def start_parameters(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    r = np.random.default_rng(1)
    share = (vocabulary.totals + 1.0) / (vocabulary.totals + 1.0).sum()
    return {"vectors": r.normal(0, 0.1, SHAPES["vectors"]), "places": np.stack([np.eye(SIZE) * 0.5] * 2), "bias": np.log(share)}


def contexts_of(classes: np.ndarray, ends: int | None) -> np.ndarray:
    """The two classes before each token of one text as one number; before the text stands its end."""
    start = CLASSES - 1 if ends is None else ends
    padded = np.concatenate([[start, start], classes])
    return padded[:-2] * CLASSES + padded[1:-1]


def learn(p: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray, weight: np.ndarray, noise: np.ndarray, seed: int) -> None:
    """One pass of noise-contrastive estimation with steps of AdaGrad; changes ``p``."""
    r = np.random.default_rng(seed)
    order = r.permutation(len(target))
    log_noise = np.log(noise * NOISE)
    past = {k: np.full(v.shape, 1e-6) for k, v in p.items()}
    for low in range(0, len(order), CHUNK):
        own = order[low: low + CHUNK]
        first, second, y = context[own] // CLASSES, context[own] % CLASSES, target[own]
        w = weight[own] / weight[own].sum()
        drawn = r.choice(CLASSES, NOISE, p=noise)
        v1, v2 = p["vectors"][first], p["vectors"][second]
        guess = v1 @ p["places"][0] + v2 @ p["places"][1]
        true = (guess * p["vectors"][y]).sum(axis=1) + p["bias"][y] - log_noise[y]
        false = guess @ p["vectors"][drawn].T + p["bias"][drawn] - log_noise[drawn]
        with np.errstate(over="ignore"):
            up = w / (1 + np.exp(true))  # how much the true class should gain
            down = w[:, None] / (1 + np.exp(-false))
        d_guess = down @ p["vectors"][drawn] - up[:, None] * p["vectors"][y]
        g = {k: np.zeros(v.shape) for k, v in p.items()}
        np.add.at(g["vectors"], y, -up[:, None] * guess)
        np.add.at(g["vectors"], drawn, down.T @ guess)
        np.add.at(g["vectors"], first, d_guess @ p["places"][0].T)
        np.add.at(g["vectors"], second, d_guess @ p["places"][1].T)
        g["places"][0], g["places"][1] = v1.T @ d_guess, v2.T @ d_guess
        np.add.at(g["bias"], y, -up)
        np.add.at(g["bias"], drawn, down.sum(axis=0))
        for k in p:
            past[k] += g[k] ** 2
            p[k] -= STEP * g[k] / np.sqrt(past[k])


def log_probabilities(p: dict[str, np.ndarray], context: np.ndarray) -> np.ndarray:
    """log10 of the probabilities of all classes in each context; they add up to 1."""
    guess = p["vectors"][context // CLASSES] @ p["places"][0] + p["vectors"][context % CLASSES] @ p["places"][1]
    scores = guess @ p["vectors"].T + p["bias"]
    scores -= scores.max(axis=1, keepdims=True)
    return (scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))) / np.log(10)


def _documents(r, vocabulary: Vocabulary) -> list[np.ndarray]:
    """The classes of the tokens of each document of a block."""
    own = vocabulary.classes(r.words.split(b"\n"))[np.frombuffer(r.places, np.int32)]
    return np.split(own, np.cumsum(np.frombuffer(r.lengths, np.int32))[:-1])


def _trained(shared, epoch: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, start = shared.value
        vocabulary = Vocabulary.restored(state)
        p = {k: v.copy() for k, v in start.items()}
        noise = (vocabulary.totals + 1.0) / (vocabulary.totals + 1.0).sum()
        ends, seen = vocabulary.top.get(END), 0
        for n, r in enumerate(r for batch in batches for r in batch.itertuples()):
            codes = [np.zeros(0, np.int64)]
            for own, held in zip(_documents(r, vocabulary), r.held_out, strict=True):
                if not held:
                    codes.append(contexts_of(own, ends) * CLASSES + own)
                    seen += len(own)
            code, times = np.unique(np.concatenate(codes), return_counts=True)
            if len(code):
                learn(p, code // CLASSES, code % CLASSES, times.astype(np.float64), noise, 1000 * epoch + n)
        if seen:
            yield pd.DataFrame({"weight": [float(seen)], "values": [np.concatenate([p[k].ravel() for k in SHAPES])]})

    return run


def train(blocks: DataFrame, vocabulary: Vocabulary, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Parameters learned from the documents of ``blocks`` that are not held out."""
    context = blocks.sparkSession.sparkContext
    own = blocks.select("held_out", "lengths", "places", "words")
    p = start_parameters(vocabulary)
    for epoch in range(epochs):
        learned = own.mapInPandas(_trained(context.broadcast((vars(vocabulary), p)), epoch), "weight double, values array<double>")
        mean = learned.select("weight", F.posexplode("values").alias("i", "x")).groupBy("i").agg(
            (F.sum(F.col("weight") * F.col("x")) / F.sum("weight")).alias("x")).toArrow()
        if not mean.num_rows:
            return p
        flat = np.zeros(mean.num_rows)
        flat[mean["i"].to_numpy()] = mean["x"].to_numpy()
        cuts = np.cumsum([int(np.prod(s)) for s in SHAPES.values()])[:-1]
        p = {k: v.reshape(s) for (k, s), v in zip(SHAPES.items(), np.split(flat, cuts), strict=True)}
    return p


def _scored(shared):
    def run(key: tuple, block: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame(columns=[x.split()[0] for x in RESULT.split(", ")])
        state, p = shared.value
        vocabulary = Vocabulary.restored(state)
        r = next(block.itertuples())
        known = np.zeros(r.words.count(b"\n") + 1, np.int64)
        for x in replies.itertuples():
            known[np.frombuffer(x.places, np.int32)] = np.frombuffer(x.counts, np.int64)
        ends, denominator = vocabulary.top.get(END), np.log10(vocabulary.n + vocabulary.words + 1)
        classes = _documents(r, vocabulary)
        contexts = np.concatenate([contexts_of(c, ends) for c in classes])
        flat = np.concatenate(classes)
        by_class = np.empty(len(flat))
        different, which = np.unique(contexts, return_inverse=True)
        order = np.argsort(which, kind="stable")
        edges = np.searchsorted(which[order], np.arange(0, len(different) + 4096, 4096))
        for n, low in enumerate(range(0, len(different), 4096)):
            own = order[edges[n]: edges[n + 1]]
            by_class[own] = log_probabilities(p, different[low: low + 4096])[which[own] - low, flat[own]]
        c = known[np.frombuffer(r.places, np.int32)]
        gain = np.log10(c + 1.0)
        tail = flat >= TOP
        by_class[tail] += gain[tail] - vocabulary.within[flat[tail] - TOP]
        at = np.cumsum([0, *map(len, classes)])[:-1]
        return pd.DataFrame({
            "doc_id": pd.array(r.ids, dtype="Int64"), "held_out": r.held_out, "n_tokens": [len(d) for d in classes],
            "n_known": np.add.reduceat((c > 0).astype(np.int64), at),
            "train_tokens": vocabulary.n, "base_score": np.add.reduceat(gain - denominator, at),
            "score": np.add.reduceat(by_class, at)})

    return run


BLOCK = "block int, ids array<long>, held_out array<boolean>, lengths binary, places binary, words binary, counts binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(docs: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """For each row of ``docs`` its token counts, the add-one unigram score and the model's score, as log10.

    The model learns from the documents whose ``crc32`` of the id, as text, leaves another rest by 7 than 2.

    Nulls: a null text is empty, so only its end is scored; a null ``doc_id`` counts as an empty text and is learned from.
    Repeated rows count and are scored each time; an empty table gives no rows; other columns are left out.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("held_out", is_held_out(F.col("doc_id")))
    blocks = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    coded = saved(dealt.groupBy("block").applyInPandas(_coded, BLOCK))
    summed = saved(coded.select("block", "words", "counts").mapInPandas(
        _dealt, "part int, block int, words binary, places binary, counts binary").groupBy("part").applyInPandas(
        _summed, "block int, words binary, places binary, counts binary, tails binary, known long"))
    context = docs.sparkSession.sparkContext
    vocabulary = Vocabulary(summed.where("block = -1").collect())  # a row for each part, with its most frequent words
    p = train(coded, vocabulary, epochs)
    replies = summed.where("block >= 0").select("block", "places", "counts")
    return coded.drop("counts").groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(
        _scored(context.broadcast((vars(vocabulary), p))), RESULT)
