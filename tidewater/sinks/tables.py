"""Tables written per micro-batch.

A micro-batch writes the folder named by its number, replacing what an interrupted
attempt left there, so a repeated batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.latest import latest

BATCH = "batch_id"


def append_batch(path: str) -> Callable[[DataFrame, int], None]:
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def _remove_before(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove the folders of the batches before ``batch_id``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in files.listStatus(folder):
        name, _, number = entry.getPath().getName().partition("=")
        if name == BATCH and int(number) < batch_id:
            files.delete(entry.getPath(), True)


class LatestTable:
    """The newest row per key, kept as one row per key and micro-batch.

    ``order`` decides between rows of a key; the later batch wins a tie. A batch writes
    only the keys it holds, but every ``fold_every``-th one writes the whole table, so a
    reader never needs more than that many batches. What is older than the fold before the
    last is removed; a reader that began before the last fold still finds all it needs.
    """

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str], fold_every: int = 50):
        self.path, self.keys, self.order, self.fold_every = path, list(keys), list(order), fold_every

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % self.fold_every == 0:
            rows = self.read(rows.sparkSession, before=batch_id).withColumn("_fresh", F.lit(0)).unionByName(
                rows.withColumn("_fresh", F.lit(1)))
            newest = latest(rows, self.keys, [*self.order, "_fresh"]).drop("_fresh")
        else:
            newest = latest(rows, self.keys, self.order or self.keys)
        append_batch(self.path)(newest, batch_id)
        if batch_id % self.fold_every == 0:
            _remove_before(rows.sparkSession, self.path, batch_id - self.fold_every)

    def read(self, spark: SparkSession, before: int | None = None, among: DataFrame | None = None) -> DataFrame:
        """The table as it is, or as it was before a batch (which must not be the first).

        ``among`` has the keys to read, other rows are left out before the newest are looked for.
        """
        batches = read_batches(spark, self.path)
        if before is None:
            before = (batches.agg(F.max(BATCH)).first()[0] or 0) + 1
        folded = (before - 1) // self.fold_every * self.fold_every
        recent = batches.where((F.col(BATCH) >= folded) & (F.col(BATCH) < before))
        if among is not None:
            wanted = among.select(*[F.col(k).alias(f"_wanted_{k}") for k in self.keys]).distinct()
            recent = recent.join(wanted, [F.col(k).eqNullSafe(F.col(f"_wanted_{k}")) for k in self.keys], "left_semi")
        return latest(recent, self.keys, [*self.order, BATCH]).drop(BATCH)


def append_lines(df: DataFrame, path: str, column: str = "value", single_file: bool = False) -> None:
    """Append text lines to a folder. ``single_file`` is for small results only."""
    lines = df.select(F.col(column).cast("string").alias("value"))
    (lines.coalesce(1) if single_file else lines).write.mode("append").text(path)
