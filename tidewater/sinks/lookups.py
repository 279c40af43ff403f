"""A latest-value table laid out for lookups by key.

Every key has a bucket, a hash of it. A generation is a folder with one file for each bucket it holds; a pointer file names
the generations that make up the table now, and the buckets of each. Readers go by the pointer: nothing is listed, and a
lookup of some keys opens the files of their buckets only.

A pointer is replaced in one step, and generations are never written twice, so a reader sees the table before a batch or
after it. A repeated batch takes the place of its first attempt.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.latest import latest

BUCKET = "bucket"
POINTER = "newest.json"
#: Says which of two generations a row is from; the later one wins a tie.
GENERATION = "generation_number"


class LookupTable:
    """The newest row per key in ``buckets`` buckets; ``order`` decides between rows of a key, the later batch wins a tie.

    A batch writes the keys it holds. Every ``fold_every``-th one writes the whole table, so a bucket is never in more than
    that many files. Generations before the last fold but one are removed: a reader that began before it still finds them.
    The number of buckets is fixed at the first batch. A null key is a key like any other.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64,
                 fold_every: int = 20):
        self.spark, self.path, self.keys, self.order = spark, path, list(keys), list(order)
        self.buckets, self.fold_every = buckets, fold_every

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """A handler for ``foreachBatch``; may also be called with batches numbered from 0 on."""
        pointer = self._pointer()
        before = [g for g in pointer["generations"] if g["batch"] < batch_id]
        folds = [g["batch"] for g in before if g["fold"]]
        fold = bool(before) and batch_id - (folds[-1] if folds else before[0]["batch"]) >= self.fold_every
        newest = latest(rows, self.keys, self.order or self.keys)
        if fold:
            newest = self._newest(self._read(before, None, newest.schema).withColumn(GENERATION, F.lit(0)).unionByName(
                newest.withColumn(GENERATION, F.lit(1))))
        name = f"batch-{batch_id}-{uuid.uuid4().hex}"
        placed = newest.withColumn(BUCKET, self._bucket(newest)).repartition(self.buckets, BUCKET)
        placed.write.partitionBy(BUCKET).parquet(f"{self.path}/{name}")
        # A folder has at most as many parts as there are buckets.
        held = sorted(int(n.partition("=")[2]) for n in self._names(name) if n.startswith(f"{BUCKET}="))
        now = [*before, {"batch": batch_id, "folder": name, "fold": fold, "held": held}]
        if fold and folds:
            now = [g for g in now if g["batch"] >= folds[-1]]
        self._point({"schema": newest.schema.json(), "buckets": self.buckets, "generations": now})
        gone = {g["folder"] for g in pointer["generations"]} - {g["folder"] for g in now}
        for folder in gone:
            self._files().delete(self._place(folder), True)

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """The whole table; ``schema`` is needed only where nothing has been written yet."""
        pointer = self._pointer()
        return self._newest(self._read(pointer["generations"], None, self._schema(pointer, schema)))

    def look_up(self, wanted: Iterable[object], schema: T.StructType | None = None) -> DataFrame:
        """The rows of the ``wanted`` keys: values, or tuples where a key has several columns."""
        kind = self._schema(self._pointer(), schema)
        keys = [w if isinstance(w, tuple) else (w,) for w in wanted]
        return self.look_up_rows(self.spark.createDataFrame(keys, T.StructType([kind[k] for k in self.keys])), schema)

    def look_up_rows(self, wanted: DataFrame, schema: T.StructType | None = None) -> DataFrame:
        """The rows of the keys in a table ``wanted`` of any size: it is joined, and its buckets alone are opened."""
        asked = wanted.select(*self.keys).distinct()
        opened = {r[0] for r in asked.select(self._bucket(asked)).distinct().collect()}  # at most all buckets
        named = asked.select(*[F.col(k).alias(f"asked_{k}") for k in self.keys])
        same = [F.col(k).eqNullSafe(F.col(f"asked_{k}")) for k in self.keys]
        pointer = self._pointer()
        rows = self._read(pointer["generations"], opened, self._schema(pointer, schema))
        return self._newest(rows.join(named, same, "left_semi"))

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest(rows, self.keys, [*self.order, GENERATION]).drop(GENERATION)

    def _read(self, generations: list[dict], opened: set[int] | None, schema: T.StructType) -> DataFrame:
        """The rows of the generations since the last fold, numbered; of the ``opened`` buckets, or of all."""
        last = max((i for i, g in enumerate(generations) if g["fold"]), default=0)
        parts = []
        for number, g in enumerate(generations[last:]):
            paths = [f"{self.path}/{g['folder']}/{BUCKET}={b}" for b in g["held"] if opened is None or b in opened]
            if paths:
                own = self.spark.read.schema(schema).parquet(*paths)
                parts.append(own.withColumn(GENERATION, F.lit(number)))
        if not parts:
            return self.spark.createDataFrame([], schema).withColumn(GENERATION, F.lit(0))
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.union(part)
        return whole

    def _bucket(self, rows: DataFrame) -> Column:
        return F.pmod(F.xxhash64(*[rows[k] for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _schema(self, pointer: dict, schema: T.StructType | None) -> T.StructType:
        if pointer["schema"] is not None:
            return T.StructType.fromJson(json.loads(pointer["schema"]))
        if schema is None:
            raise ValueError("nothing has been written yet: give a schema")
        return schema

    def _pointer(self) -> dict:
        if not self._files().exists(self._place(POINTER)):
            return {"schema": None, "buckets": self.buckets, "generations": []}
        found = json.loads(self.spark.read.option("wholetext", True).text(f"{self.path}/{POINTER}").first()[0])
        if found["buckets"] != self.buckets:
            raise ValueError(f"the table has {found['buckets']} buckets")
        return found

    def _point(self, pointer: dict) -> None:
        jvm, draft = self.spark._jvm, self._place(f"_{uuid.uuid4().hex}")
        out = self._files().create(draft, True)
        out.write(bytearray(json.dumps(pointer).encode()))
        out.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        place = self._place(POINTER)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._files().getUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, place, how)

    def _place(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self._files().listStatus(self._place(folder))]
