"""The registered queries: each operator on its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import oracles
from tidewater.llm.centroid_clustering import cluster, whole_vectors, with_inertia
from tidewater.llm.common import new_folder, saved, table
from tidewater.llm.language_model import score_texts
from tidewater.llm.line_dedup import dedup_lines
from tidewater.llm.near_duplicates import near_duplicates
from tidewater.llm.packing import pack
from tidewater.llm.pieces import decode, encode
from tidewater.llm.quality_rules import quality_rules
from tidewater.llm.substring_dedup import duplicate_passages
from tidewater.llm.suffix_dedup import remove_repeats
from tidewater.llm.topk_search import top_k, whole_numbers
from tidewater.llm.url_filters import repeated_page_keys, url_filter
from tidewater.llm.wavelet_shards import read_documents, write_shards
from tidewater.llm.whitening import whiten

Build = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, tuple[Build, str | None]] = {}


def registered(sql: str | None = None):
    def add(build: Build) -> Build:
        REGISTERED[build.__name__] = (build, sql)
        return build

    return add


def load() -> dict[str, tuple[Build, str | None]]:
    return REGISTERED


@registered(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@registered(oracles.QUALITY)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept")


@registered()
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@registered(oracles.TOP_K)
def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_numbers(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@registered()
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@registered()
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), figures=True)


@registered()
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_passages(table(spark, sf_dir, "documents"))


@registered()
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: The rules of the URL query: verdict, host and path.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/"))


@registered(oracles.URLS)
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter(pages, URL_RULES, repeated_page_keys(pages))


@registered()
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


@registered()
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    # Written first: encoding and decoding in one stage would hold the workers of both, and batches of 64 MB.
    encoded = saved(encode(table(spark, sf_dir, "documents"), path))
    return decode(encoded, path).select("doc_id", F.size("ids").alias("n_pieces"), "ids", F.sha2("text", 256).alias("decoded_sha256"))


@registered(oracles.CLUSTERS)
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(*cluster(whole_vectors(table(spark, sf_dir, "embeddings"), 256, size=64)))


@registered()
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten(whole_vectors(table(spark, sf_dir, "embeddings"), 64, 1_000_000))
    return out.withColumn("deviation", F.col("deviation").cast("long"))


@registered()
def op13_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    write_shards(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(spark, folder).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
