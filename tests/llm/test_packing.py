"""Packing against the tokenizer itself and against brute force."""

import itertools
import zlib
from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewater.llm.packing import combinations, fullest, pack
from tidewater.llm.tokens import Encoder
from tests.conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet="ab 's\n\t  .9é<|endoftext|>　\x1c", max_size=40))
def test_cut_encoding_equals_whole_encoding(text):
    whole = Tokenizer.from_file(PATH) if not hasattr(test_cut_encoding_equals_whole_encoding, "t") else \
        test_cut_encoding_equals_whole_encoding.t
    test_cut_encoding_equals_whole_encoding.t = whole
    own = test_cut_encoding_equals_whole_encoding.__dict__.setdefault("own", Encoder(PATH))
    assert array("I", own.batch([text])[0]).tolist() == whole.encode(text, add_special_tokens=False).ids


@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), min_size=1, max_size=5), st.integers(1, 25))
def test_fullest_is_the_best_subset(counts, room):
    pool = [n for n, c in counts.items() for _ in range(c)]
    best = max(s for k in range(len(pool) + 1) for c in itertools.combinations(pool, k) if (s := sum(c)) <= room)
    got = fullest(room, sorted(counts.items(), reverse=True))
    assert sum(n * c for n, c in got) == best and all(c <= counts[n] for n, c in got)


@given(st.dictionaries(st.integers(1, 20), st.integers(1, 50), max_size=8))
def test_combinations_use_all_pieces_and_fit(counts):
    used: dict[int, int] = {}
    for bins, parts in combinations(counts, 20):
        assert sum(n * c for n, c in parts) <= 20
        for n, c in parts:
            used[n] = used.get(n, 0) + bins * c
    assert used == counts


def check(rows, texts, tokenizer, capacity):
    expected = {}
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first, start, piece = len(ids) % capacity or capacity, 0, 0
        while start < len(ids):
            size = first if start == 0 else capacity
            own = (doc_id, piece, start, size, zlib.crc32(array("I", ids[start:start + size]).tobytes()))
            expected[own] = expected.get(own, 0) + 1
            start, piece = start + size, piece + 1
    got = {}
    for r in rows:
        own = (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
        got[own] = got.get(own, 0) + 1
    assert got == expected
    for _, own in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), lambda r: r["sequence_id"]):
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity


def test_odd_documents(spark, tokenizer):
    texts = [(1, "a b c"), (1, "a b c"), (None, None), (2, ""), (3, "word " * 3000), (4, "two  spaces\n\n here"), (5, None)]
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in texts], "doc_id long, text string, ids string, length int")
    check(pack(docs, PATH).collect(), texts, tokenizer, 1024)
    small = pack(docs, PATH, capacity=16, keep_ids=True).collect()
    check(small, texts, tokenizer, 16)
    assert all(len(r["ids"]) == r["length"] for r in small)
    assert pack(docs.limit(0), PATH).collect() == []


def test_whole_table(spark, tokenizer):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = pack(docs.repartition(5), PATH).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer, 1024)
    tokens, bins = sum(r["length"] for r in rows), len({r["sequence_id"] for r in rows})
    assert bins <= 1.02 * tokens / 1024 + 1


def test_new_words_are_encoded_together(tokenizer, monkeypatch):
    """Thousands of new words take a few calls' texts, not one each; the ids are those of the whole text."""
    texts = [" ".join(f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}ua{'uvwxyz'[i // 100 % 6]}{s}" for i in range(600))
             for s in ("", ",", ".", "K,", "<|endoftext|>", "\x1c", "é.", ".,", "'s", "\u0301,")] + [" x, y. ,", "", "\n. a", "a "]
    own, sizes = Encoder(PATH), []
    encode = own.tokenizer.encode_batch_fast

    class Counting:
        def __getattr__(self, name):
            return getattr(tokenizer, name)

        def encode_batch_fast(self, texts, **kwargs):
            sizes.append(len(texts))
            return encode(texts, **kwargs)

    own.tokenizer = Counting()
    got = own.batch(texts)
    assert [array("I", g).tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(sizes) < 2500  # of some 6,000 words, and twice as many new ones without their signs
    again = sum(sizes)
    assert own.batch(texts) == got and sum(sizes) - again < 30
