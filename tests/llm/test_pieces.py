"""Encoding against a plain Viterbi over whole texts, decoding against the text and the library."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from sentencepiece import SentencePieceProcessor

from tidewater.llm import pieces as pc

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(text, model, table, longest, lowest):
    t = pc.SPACE + text.replace(" ", pc.SPACE) if text else ""
    best = [(0.0, 0, [])] + [None] * len(t)
    for end in range(1, len(t) + 1):
        for low in range(max(0, end - longest), end):
            part = t[low:end]
            if part in table:
                ids, score = [table[part][0]], table[part][1]
            elif end - low == 1:
                ids, score = [model.piece_to_id(f"<0x{b:02X}>") for b in part.encode()], lowest - pc.PENALTY
            else:
                continue
            option = (best[low][0] + score, -low, best[low][2] + ids)
            if best[end] is None or option[:2] > best[end][:2]:
                best[end] = option
    return best[-1][2]


def test_texts(spark):
    model = SentencePieceProcessor(model_file=PATH)
    table = {r["piece"]: (r["id"], r["score"]) for r in pc.piece_table(spark, PATH).collect()}
    assert not any("\n" in p or pc.SPACE in p.lstrip(pc.SPACE) for p in table)
    longest, lowest = max(map(len, table)), min(s for _, s in table.values())
    docs = [(i, r["text"]) for i, r in enumerate(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect())]
    docs += [(100, None), (101, ""), (102, " "), (103, "  two  spaces\n\nand lines \n"), (104, "\x00 漢字 🎉🎉 ÿ\tx"), (None, "null id"),
             (105, "a" * 300), (105, "a" * 300), (106, "\n")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, unit string, block int")
    back = pc.decode(pc.encode(df, PATH), PATH).collect()
    got = sorted(((r["doc_id"], list(r["ids"]), r["text"]) for r in back), key=repr)
    assert got == sorted(((i, brute(t or "", model, table, longest, lowest), t or "") for i, t in docs), key=repr)
    for _, ids, text in got:
        assert model.decode(ids) == text or not text
    assert pc.encode(df.limit(0), PATH).collect() == []


def test_long_units(spark):
    """Slices: units longer than a slice, with pieces over the cuts, and a whole text without a space."""
    model = SentencePieceProcessor(model_file=PATH)
    table = {r["piece"]: (r["id"], r["score"]) for r in pc.piece_table(spark, PATH).collect()}
    longest, lowest = max(map(len, table)), min(s for _, s in table.values())
    r = random.Random(3)
    words = ["information", "the", "é", "漢", "ing", "a", "international", "zq"]
    docs = [(n, "".join(r.choice(words) for _ in range(n // 4))[:n]) for n in (255, 256, 257, 511, 512, 513, 1500, 20_000)]
    docs += [(-1, "a" * 3000), (-2, "x" * 255 + " " + "-" * 256), (-3, "".join(r.choice(words) for _ in range(30_000))[:100_000])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {row["doc_id"]: list(row["ids"]) for row in pc.encode(df, PATH).collect()}
    for n, text in docs:
        assert got[n] == brute_slices(text, model, table, longest, lowest), n


def brute_slices(text, model, table, longest, lowest):
    """``brute`` with back pointers, for long texts."""
    t = pc.SPACE + text.replace(" ", pc.SPACE)
    best = [(0.0, 0, [])] + [None] * len(t)
    for end in range(1, len(t) + 1):
        for low in range(max(0, end - longest), end):
            part = t[low:end]
            if part in table:
                ids, score = [table[part][0]], table[part][1]
            elif end - low == 1:
                ids, score = [model.piece_to_id(f"<0x{b:02X}>") for b in part.encode()], lowest - pc.PENALTY
            else:
                continue
            option = (best[low][0] + score, -low, ids)
            if best[end] is None or option[:2] > best[end][:2]:
                best[end] = option
    at, out = len(t), []
    while at:
        out.append(best[at][2])
        at = -best[at][1]
    return [i for ids in reversed(out) for i in ids]


def test_texts_are_not_shuffled(spark):
    """Neither texts nor their units take room on the executors' disks."""
    df = spark.createDataFrame([(1, "some words"), (2, "and some more")], "doc_id long, text string").repartition(2).localCheckpoint()
    plan = pc.encode(df, PATH)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan and "CoGroup" not in plan


def test_blocks(monkeypatch):
    """Rows in blocks of some bytes give what they give together; equal hashes of other characters are no pieces."""
    rows = [("a", 0, -1.0), ("ab", 1, -1.5), ("b", 2, -0.5), ("abb", 3, -2.0)]
    monkeypatch.setattr(pc.Lattice, "FACTOR", np.uint64(0))  # all hashes are 0
    lattice = pc.Lattice(rows[:2] + rows[3:], -2.0)
    ids, sizes = lattice.paths(["ab", "abb", "a", "xab"])
    assert (ids.tolist(), sizes.tolist()) == ([1, 3, 0, -1 - ord("x"), 1], [1, 1, 1, 2])
    monkeypatch.undo()
    texts = ["a b", "", "abb ab\n\nb", "x" * 40, "abab " * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], ["doc_id", "text"])

    class Whole:
        value = pc.Lattice(rows, -2.0)

    def encoded(size):
        monkeypatch.setattr(pc, "BLOCK_BYTES", size)
        return [r for part in pc._encoder(Whole, [1000 + b for b in range(256)])(iter([batch])) for r in part.to_pylist()]

    assert encoded(8) == encoded(1000) and len(encoded(8)) == 5


def test_decode_without_ids(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, [], "y")], "n int, ids array<int>, text string").coalesce(1)
    assert sorted(map(tuple, pc.decode(df, PATH).collect())) == [(1, None, None), (2, [], "")]
    own = pc.decode(df.select("n", "ids"), PATH, text="ids")
    assert sorted(map(tuple, own.collect())) == [(1, None), (2, "")]


def test_query_encodes_and_decodes_in_stages_of_their_own(spark):
    """One stage with both would hold the Python workers of both at once."""
    from tests.conftest import SMALL
    from tidewater.llm.queries import op2_sentencepiece

    plan = op2_sentencepiece(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_a_batch_is_encoded_in_little_memory():
    r, model = random.Random(4), SentencePieceProcessor(model_file=PATH)
    rows = [(model.id_to_piece(i), i, model.get_score(i)) for i in range(3, model.get_piece_size()) if not model.is_byte(i)]

    class Sent:
        value = pc.Lattice(rows, min(score for _, _, score in rows))

    texts = [" ".join("".join(r.choices("aeinrstol", k=7)) for _ in range(6000)) for _ in range(120)]  # 6 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(120)), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    try:
        got = sum(part.num_rows for part in pc._encoder(Sent, list(range(256)))(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == 120 and peak < 500e6, peak
