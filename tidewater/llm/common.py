"""Helpers the operators share: words, 128-bit keys, tables in the shared folder, sized blocks."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import shared_dir

#: The characters that separate words.
SPACES = "\t\n\x0b\x0c\r "
#: Small tables may be broadcast up to so many rows of a few numbers each; beyond, joins shuffle.
SMALL_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """The path of a folder that is not there yet, in the shared folder."""
    return f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"


#: Spark removes the shuffle files of a statement when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What a batch of rows for Python may hold: a task has it in the JVM, where its buffers double, and in its worker. Rows of long
#: texts or lists fill Spark's default of 64 MB.
BATCH_BYTES, MOST_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20)


def saved(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and kept when an executor is lost.

    The shuffle files of the computation go when the table is written: nothing reads them any more, and the executors'
    disks hold those of one computation at a time. Batches for Python are small. The session's own settings are put back.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    own = {CLEANUP: "true", BATCH_BYTES: MOST_BYTES}
    before = {key: spark.conf.get(key) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    table = spark.read.schema(df.schema).parquet(path)
    table.saved_at = path
    if (made := _made.get()) is not None:
        made.append(table)
    return table


#: The tables saved so far by the ``settled`` call that runs, if one does.
_made: ContextVar[list[DataFrame] | None] = ContextVar("made", default=None)


def settled(build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` as a saved table; the tables that ``build`` saved on the way are removed, as nothing reads them any more."""
    outer, own = _made.get(), []
    token = _made.set(own)
    result = None
    try:
        result = saved(build())
    finally:
        _made.reset(token)
        dropped(*[t for t in own if t is not result])
    if outer is not None:
        outer.append(result)
    return result


def dropped(*tables: DataFrame) -> None:
    """Remove ``saved`` tables. All that was computed from them must have been written."""
    for t in tables:
        spark = t.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(t.saved_at)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def words(text: Column) -> Column:
    """The runs of ``[^\\x20\\x09-\\x0D]`` of a text; of null, none."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(plain, " "), "")


def wide_key(*parts: Column) -> list[Column]:
    """Two independent 64-bit hashes: equal for different values with a probability near 2**-128."""
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("second"), *parts).alias("h2")]


def small_side(df: DataFrame, most_rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has been counted and is small, else as it is."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def distinct_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``ids`` (``doc_id, h1, h2``), ``copies`` (those and ``node``) and ``texts`` (``node``, ``text``) of ``docs``.

    A text's node is the smallest id that has it; copies are the other ids. Rows with a null id are left out, a null text
    is empty. Texts are not shuffled unless there are many copies: their ids are broadcast if they are few.
    """
    rows = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", *wide_key(F.col("text")))
    ids = saved(rows.select("doc_id", "h1", "h2"))
    nodes = ids.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"))
    copies = saved(ids.join(nodes, ["h1", "h2"]).where("doc_id <> node").distinct())
    texts = rows.join(small_side(copies.select("doc_id", "h1", "h2")), ["doc_id", "h1", "h2"], "left_anti")
    return ids, copies, texts.select(F.col("doc_id").alias("node"), "text")


def word_hashes(texts: DataFrame) -> DataFrame:
    """``node`` and the hashes ``w`` of its text's words."""
    return texts.select("node", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("w"))
