"""Base scores against plain Python; the model's probabilities add up to 1 and fit held-out texts better than the base."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import language_model as lm


def plain(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w] + [""]


def test_against_plain_python(spark):
    r = random.Random(3)
    words = {k: [f"{k}{i}{k}" for i in range(60)] for k in "ÉbQ"}
    docs = []
    for i in range(400):
        own = words[r.choice("ÉbQ")]
        docs.append((i, "\n".join(r.choice(own) for _ in range(r.randint(5, 60)))))
    docs += [(500, None), (None, "É0É x"), (501, ""), (502, " \t\r\n\x0b\x0c"), (7, docs[7][1]), (503, "unknown\x1cword q1q " * 900)]
    df = spark.createDataFrame([(*d, "x", 1.0) for d in docs], "doc_id long, text string, block string, score double")
    got = sorted(map(tuple, lm.score_texts(df).collect()), key=lambda x: (repr(x[0]), x[2]))
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in docs]
    counts = Counter(w for (i, t), h in zip(docs, held, strict=True) if not h for w in plain(t))
    n = sum(counts.values())
    expected = []
    for (i, t), h in zip(docs, held, strict=True):
        own = plain(t)
        expected.append((i, h, len(own), sum(w in counts for w in own), n,
                         sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in own)))
    expected.sort(key=lambda x: (repr(x[0]), x[2]))
    for g, e in zip(got, expected, strict=True):
        assert g[:5] == e[:5] and g[5] == pytest.approx(e[5]) and math.isfinite(g[6])
    out = [g for g in got if g[1]]
    assert len(out) > 30 and sum(g[6] for g in out) > sum(g[5] for g in out)


def test_probabilities_add_up():
    words, tails = [f"w{i}".encode() for i in range(100)], np.zeros((lm.TAILS, 2), np.int64)
    for i, w in enumerate(words):
        tails[zlib.crc32(w[-2:]) % lm.TAILS] += (i + 1, 1)
    rows = [{"words": b"\n".join(words), "counts": np.arange(1, 101).tobytes(), "tails": tails.tobytes(), "known": 100}]
    vocabulary = lm.Vocabulary(rows)
    p = lm.start_parameters(vocabulary)
    r = np.random.default_rng(1)
    context, target = r.integers(0, lm.CLASSES**2, 5000), r.integers(0, 5, 5000)
    before = lm.log_probabilities(p, context)[np.arange(5000), target].mean()
    noise = (vocabulary.totals + 1.0) / (vocabulary.totals + 1.0).sum()
    for seed in range(3):
        lm.learn(p, context, target, np.ones(5000), noise, seed)
    after = lm.log_probabilities(p, context)
    assert np.allclose((10**after).sum(axis=1), 1) and after[np.arange(5000), target].mean() > before


def test_empty(spark):
    assert lm.score_texts(spark.createDataFrame([], "doc_id long, text string")).collect() == []
