"""Wavelet matrices against plain lists, and files against the tokenizer."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tidewater.llm import queries, wavelet_shards
from tidewater.llm.wavelet_shards import WaveletMatrix, WordEncoder, occurrences, read_documents, read_shards, token_counts, write_shards

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize(("n", "most"), [(0, 1), (1, 1), (5, 1), (700, 2), (3000, 37), (2048, 60_000), (513, 2**32 - 1)])
def test_matrix(n, most):
    r = random.Random(n)
    ids = np.array([min(int(r.paretovariate(0.4)), most) if r.random() < 0.7 else r.randint(0, most) for _ in range(n)], np.uint32)
    m = WaveletMatrix.from_bytes(WaveletMatrix.of(ids).to_bytes())
    plain = ids.tolist()
    assert m.ids().tolist() == plain and m.access(range(n)).tolist() == plain
    for token in {*r.sample(plain, min(n, 12)), most, 12345}:
        places = [i for i, x in enumerate(plain) if x == token]
        assert m.count(token) == len(places) and m.select(token).tolist() == places
        for place in (0, 1, n // 3, 512, n, n + 9):
            assert m.rank(token, place) == sum(x == token for x in plain[:place])
        if places:
            assert m.select(token, [len(places) - 1]).tolist() == [places[-1]]
        with pytest.raises(IndexError):
            m.select(token, [len(places)])


def test_other_bytes():
    with pytest.raises(ValueError, match="not a file"):
        WaveletMatrix.from_bytes(b"something else that is no shard")


def expected(docs):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, ids))
        start += len(ids)
    return out


def read(spark, folder):
    found = read_documents(spark, folder).collect()
    return [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in sorted(found, key=lambda r: r["start"])]


def test_files(spark, tmp_path):
    r = random.Random(2)
    odd = ["", None, "  two  spaces\n\nand lines\t\ttabs ", "Café café  nbsp em ́x", "<|endoftext|> it's 1234 don't!!", "a" * 5000,
           "漢字 \U0001f600\U0001f600 x", "word " * 3000]
    docs = [(10 * i + 3, odd[i] if i < len(odd) else " ".join(r.choice(["Alpha", "beta", "gamma's", "7"]) for _ in range(r.randint(0, 90))))
            for i in range(120)]
    docs += [(500_000, "same"), (500_000, "same")]
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in r.sample(docs, len(docs))], "doc_id long, text string, h string, first int")
    folder = str(tmp_path / "shards")
    write_shards(df.repartition(5), folder, PATH, shard_tokens=900, task_chars=9000)
    want = expected(docs)
    assert read(spark, folder) == want
    shards = read_shards(spark, folder).collect()
    assert len(shards) > 5 and all(s["n_tokens"] <= 900 or len(s["doc_ids"]) == 1 for s in shards)
    flat = [(i, k, t) for i, _, ids in want for k, t in enumerate(ids)]
    common = max({t for _, _, t in flat}, key=[t for _, _, t in flat].count)
    counts = {c["token"]: c["n"] for c in token_counts(spark, folder, [1, common, 49_000]).collect()}
    assert counts == {t: sum(x == t for _, _, x in flat) for t in (1, common, 49_000)}
    found = sorted((o["position"], o["doc_id"], o["place"]) for o in occurrences(spark, folder, common).collect())
    assert found == [(n, i, k) for n, (i, k, t) in enumerate(flat) if t == common]


def test_words_are_cut_as_the_tokenizer_cuts_them():
    r = random.Random(4)
    encoder, tokenizer = WordEncoder(PATH), Tokenizer.from_file(PATH)
    signs = "abzAZ09'sdtmrevl.,!<|>#-_é\u00c9ßÿ×÷ª²\u0130\u03a3Σς\u00a0\u0085\x1c\t\x0b\r漢\u0301 \n"
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    texts += ["it's we'll you've don't I'm they're he'd 'salut '' '! !'s", "ÀÖØÞ àöøþ", "x<|endoftext|>y <|startoftext|>"]
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.batch(texts)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_null_ids_and_no_rows(spark, tmp_path):
    df = spark.createDataFrame([(None, "b c"), (None, "b c"), (7, None), (-2, "d")], "doc_id long, text string")
    write_shards(df, str(tmp_path / "a"), PATH)
    assert read(spark, str(tmp_path / "a")) == expected([(None, "b c"), (None, "b c"), (-2, "d"), (7, None)])
    write_shards(df.limit(0), str(tmp_path / "b"), PATH)
    assert read(spark, str(tmp_path / "b")) == []


def test_query(spark):
    got = {r["doc_id"]: r for r in queries.REGISTERED["op13_token_binary"][0](spark, SMALL).collect()}
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    want = expected(docs)
    assert len(got) == len(want)
    for doc_id, start, ids in want:
        g = got[doc_id]
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_a_full_cache_forgets_no_word_in_use(monkeypatch):
    monkeypatch.setattr(wavelet_shards, "CACHED_WORDS", 2)
    encoder, learned = WordEncoder(PATH), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: (learned.extend(words), learn(words)))
    first = encoder.batch(["alpha beta 7th", "beta it's"])
    assert encoder.batch(["alpha beta 7th", "beta it's"]) == first == encoder.batch(["alpha beta 7th", "beta it's"])
    assert sorted(learned) == ["7th", "alpha", "beta", "it's"]


def test_words_before_signs_are_looked_up_without_them():
    """Case and a comma or full stop behind a word make no new word; the ids are those of the tokenizer."""
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, tokenizer = WordEncoder(path), Tokenizer.from_file(path)
    texts = ["Word, word. WORD, word\nWord.", "word, ", "a;, b.. c., ß, é. 3, d.e, x ,y , . z.", "", "É, ÀB. İ, K. ǅ.", "é, ö. end."]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.batch(texts) == want
    special = ["A <|endoftext|> b, c. ", "<|ENDOFTEXT|>, Word, x"]
    assert encoder.batch(special) == [
        np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in special]
    few = WordEncoder(path)
    few.batch(["Word, word. WORD, word and"])
    assert set(few.words) == {"word", ",", ".", "and"}
