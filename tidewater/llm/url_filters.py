"""URL filters: host and path rules, and an exact list of keys as a cascade of Bloom filters.

The key universe is the set of all keys of the corpus. The first filter holds the listed keys, the second those other keys
of the universe that the first lets through, the third those listed keys that the second lets through, and so on until
none is let through. For any key of the universe the first filter that stops it tells whether it is listed, so the filters
answer exactly, without a join. A cascade of more than ``MOST_BYTES`` is built for parts of the keys, one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import saved, wide_key

BITS_PER_KEY, PROBES = 10, 7
#: The largest first filter that is sent to tasks; more keys are dealt to parts.
MOST_BYTES = 4_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, in lower case, and path of a URL; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``struct(size, rule, verdict)`` of the longest of ``(verdict, rule)`` that fits, or null. A rule is host and path."""
    fits = []
    for verdict, rule in rules:
        name, _, rest = rule.partition("/")
        own = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        fits.append(F.when(own, F.struct(
            F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def _probes(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    first, step = h1.astype(np.int64).view(np.uint64), h2.astype(np.int64).view(np.uint64) | np.uint64(1)
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    turns = np.arange(PROBES, dtype=np.uint64)[:, None]
    x = (first ^ salt)[None, :] + step[None, :] * (turns + np.uint64(level * PROBES))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) % np.uint64(bits)


def _holds(words: np.ndarray, probes: np.ndarray) -> np.ndarray:
    return (words[(probes >> np.uint64(6)).astype(np.int64)] >> (probes & np.uint64(63)) & np.uint64(1)).all(axis=0)


def listed(h1: np.ndarray, h2: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Whether each key is listed, by the filters ``levels``."""
    answer, open_ = np.zeros(len(h1), bool), np.arange(len(h1))
    for n, words in enumerate(levels):
        passed = _holds(words, _probes(h1[open_], h2[open_], n, len(words) * 64))
        # Stopped by the first, third, ... filter: not listed; by the second, fourth, ...: listed.
        answer[open_[~passed]] = n % 2 == 1
        open_ = open_[passed]
    answer[open_] = len(levels) % 2 == 1
    return answer


def _bits_of(level: int, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            probes = _probes(batch["h1"].to_numpy(), batch["h2"].to_numpy(), level, bits).ravel()
            yield pd.DataFrame({"word": (probes >> np.uint64(6)).astype(np.int64),
                                "mask": (np.uint64(1) << (probes & np.uint64(63))).view(np.int64)})

    return run


def _let_through(words, level: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[_holds(words.value, _probes(batch["h1"].to_numpy(), batch["h2"].to_numpy(), level, len(words.value) * 64))]

    return run


def cascade(keys: DataFrame) -> list[np.ndarray]:
    """The filters for ``keys`` (``h1, h2, is_listed``), the whole universe of one part."""
    context, levels = keys.sparkSession.sparkContext, []
    inside, outside = keys.where("is_listed").select("h1", "h2"), keys.where("NOT is_listed").select("h1", "h2")
    count = inside.count()
    while count:
        bits = max(64, -(-count * BITS_PER_KEY // 64) * 64)
        level = len(levels)
        found = inside.mapInPandas(_bits_of(level, bits), "word long, mask long").groupBy("word").agg(
            F.bit_or("mask").alias("mask")).toArrow()
        words = np.zeros(bits // 64, np.uint64)
        words[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
        levels.append(words)
        wrong = saved(outside.mapInPandas(_let_through(context.broadcast(words), level), "h1 long, h2 long"))
        inside, outside, count = wrong, inside, wrong.count()
    return levels


def _marked(levels):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns=["h1", "h2"]).assign(
                is_listed=listed(batch["h1"].to_numpy(), batch["h2"].to_numpy(), levels.value))

    return run


def mark_listed(rows: DataFrame, key: str, keys: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``rows`` with ``is_listed``: whether ``keys`` (a column ``key``) has the row's key. A null key is not listed."""
    hashed = rows.withColumns(dict(zip(("h1", "h2"), wide_key(F.col(key)), strict=True)))
    universe = hashed.where(F.col(key).isNotNull()).select("h1", "h2", F.lit(1).alias("here"), F.lit(0).alias("named"))
    named = keys.where("key IS NOT NULL").select(*wide_key(F.col("key")), F.lit(0).alias("here"), F.lit(1).alias("named"))
    flags = saved(universe.union(named).groupBy("h1", "h2").agg(
        F.max("here").alias("here"), F.max("named").alias("named")).where("here = 1").select(
        "h1", "h2", (F.col("named") == 1).alias("is_listed")))
    parts = max(1, -(-flags.where("is_listed").count() * BITS_PER_KEY // (8 * most_bytes)))
    context, out = rows.sparkSession.sparkContext, None
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", is_listed boolean"
    for part in range(parts):
        own = F.pmod(F.xxhash64("h1"), F.lit(parts)) == part
        levels = context.broadcast(cascade(flags.where(own)))
        marked = hashed.where(own & F.col(key).isNotNull()).mapInPandas(_marked(levels), schema)
        out = marked if out is None else out.union(marked)
    return out.union(rows.where(F.col(key).isNull()).withColumn("is_listed", F.lit(False)))


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str]], listed_keys: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages`` (``page_id``, ``url``).

    The longest rule that fits decides; without one, pages are blocked whose host and path, as one string, are among
    ``listed_keys`` (a column ``key``), others are allowed.

    Nulls: a null URL, or one without ``://``, has an empty host and path. A null ``page_id`` stays null. Repeated rows
    give repeated results, empty tables none; other columns are left out.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "fit", best_rule(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled"),
        F.concat("host", "path").alias("key"))
    marked = mark_listed(parsed, "key", listed_keys, most_bytes)
    return marked.select("page_id", "host", "path", "rule", F.coalesce(
        "ruled", F.when(F.col("is_listed"), "block").otherwise("allow")).alias("verdict"))


def repeated_page_keys(pages: DataFrame) -> DataFrame:
    """``key``: host and path, as one string, that several rows of ``pages`` have."""
    host, path = host_and_path(F.col("url"))
    keys = pages.select(F.concat(host, path).alias("key")).where("key <> ''")
    return keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
