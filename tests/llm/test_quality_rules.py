"""Counts against plain Python, cutoffs against the exact binomial distribution, the SQL on odd rows."""

import math
import re
from collections import Counter

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.oracle import connect, differences
from tidewater.llm import oracles
from tidewater.llm import quality_rules as qr


def counts(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    repeated = {i + d for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated),
            len(w) < 50 or 100 * len(repeated) > 50 * len(w))


ODD = [None, "", " \n\t\x0b", "a b", "a b c", "a b c a b c", "x\n\nx\n x\n\t\n\t", "é#* b\x85c 漢", "w " * 3000,
       "\n".join(f"{i} {i % 7} {i % 5}" for i in range(60)), " ".join(f"t{i}" for i in range(80)), "ab\r\nab\r\nab"]


def test_counts_and_sql_on_odd_texts(spark, tmp_path):
    docs = [(i, t, "en" if i % 2 else None, "x", 1) for i, t in enumerate(ODD)] + [(None, ODD[10], "en", "x", 1), (3, "a b", None, "x", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, n_words string, figures int")
    labels = spark.createDataFrame([(10, 1, 0), (10, 0, 0), (None, 1, 0), (9, None, 0), (3, 7, 1)], "doc_id long, quality int, toxic int")
    got = sorted((tuple(r)[:7] for r in qr.quality_rules(df, labels).collect()), key=repr)
    assert got == sorted(((i, *counts(t)) for i, t, *_ in docs), key=repr)
    for name, frame in (("documents", df.drop("n_words", "figures")), ("labels", labels)):
        pq.write_table(frame.toArrow(), f"{tmp_path}/{name}.parquet")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert differences(qr.quality_rules(df, labels).select(*columns), connect(str(tmp_path)), oracles.QUALITY) == ""
    kept = qr.kept_documents(df, labels)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {9, 10, None}
    assert qr.quality_rules(df.limit(0), labels.limit(0)).collect() == []


def test_binomial(spark):
    cases = [(0, 10, .1), (3, 10, .1), (5, 2000, .004), (40, 9000, .004), (2, 3, .5)]
    for k, n, p in cases:
        got = spark.range(1).select(qr.log_binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        assert math.isclose(math.exp(got), sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1)), rel_tol=1e-9)


def test_certified_cutoffs_reject_junk_and_keep_good(spark):
    good = " ".join(f"w{i}" for i in range(60))
    docs = [(i, good.replace("w1 ", f"v{i} "), "en") for i in range(2500)]
    docs += [(5000 + i, good.replace(" ", "*** "), "en") for i in range(300)]
    docs += [(9000 + i, good.replace(" ", "*** "), "few") for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = df.select("doc_id", (F.col("doc_id") < 5000).cast("int").alias("quality"))
    kept = {r["doc_id"] for r in qr.quality_rules(df, labels).where("kept").collect()}
    # Too few labels certify nothing in the small stratum, so it keeps its documents.
    assert kept == {i for i, *_ in docs if i < 5000 or i >= 9000}
