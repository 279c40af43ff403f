"""Exactly-once delivery in two phases, for readers that take committed records only.

Each task of a micro-batch stages its records as one part. When all have, the batch is committed by one manifest that
names its parts, put in place by a rename. A batch that stops before has no manifest, so none of its records is seen; a
batch that runs again after its manifest finds it and takes its new parts away, so none is seen twice.

``path`` may be on any store Arrow's file systems open; the records are Parquet files and Spark reads them back.
"""

from __future__ import annotations

import hashlib
import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from tidewater.streaming.queries import writer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "tidewater_two_phase"
PARTS, BATCHES = "parts", "batches"
MANIFEST = "part string, records bigint"


@dataclass
class Staged(WriterCommitMessage):
    """A task's part; ``None`` if it had no records."""

    part: str | None
    records: int


class Delivery(DataSourceStreamArrowWriter):
    def __init__(self, path: str, query: str):
        self.path, self.query = path, query

    def _open(self) -> tuple[fs.FileSystem, str]:
        store, root = fs.FileSystem.from_uri(self.path)
        for folder in (PARTS, BATCHES):
            store.create_dir(f"{root}/{folder}", recursive=True)
        return store, root

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """First phase, in a task."""
        store, root = self._open()
        part, records, out = f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if batch.num_rows:
                    out = out or pq.ParquetWriter(f"{root}/{PARTS}/{part}", batch.schema, filesystem=store)
                    out.write_batch(batch)
                    records += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Staged(part if records else None, records)

    def _manifest(self, root: str, batch: int) -> str:
        return f"{root}/{BATCHES}/{self.query}-{batch:020d}.json"

    def _committed(self, store: fs.FileSystem, root: str, batch: int) -> set[str] | None:
        """The parts of a committed batch."""
        manifest = self._manifest(root, batch)
        if store.get_file_info(manifest).type == fs.FileType.NotFound:
            return None
        with store.open_input_stream(manifest) as file:
            return {json.loads(line)["part"] for line in file.read().decode().splitlines()}

    def _drop(self, store: fs.FileSystem, root: str, messages: list[Staged | None], keep: set[str]) -> None:
        for message in messages:
            if message is not None and message.part is not None and message.part not in keep:
                store.delete_file(f"{root}/{PARTS}/{message.part}")

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        """Second phase, on the driver: one line for each part."""
        store, root = self._open()
        before = self._committed(store, root, batchId)
        if before is not None:
            self._drop(store, root, messages, before)
            return
        lines = [json.dumps({"part": m.part, "records": m.records}) for m in messages if m is not None and m.part]
        # Spark's readers pass over names that start with an underscore.
        hidden = f"{root}/{BATCHES}/_{uuid.uuid4().hex}"
        with store.open_output_stream(hidden) as file:
            file.write("".join(f"{line}\n" for line in lines).encode())
        store.move(hidden, self._manifest(root, batchId))

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        """A failed batch takes its parts away, unless it was committed before it failed."""
        store, root = self._open()
        self._drop(store, root, messages, self._committed(store, root, batchId) or set())


class TwoPhase(DataSource):
    """``path`` and ``query``, which names the checkpoint: batch numbers count within it."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> Delivery:
        return Delivery(self.options["path"], self.options["query"])


def deliver(df: DataFrame, path: str, checkpoint: str, format: type[DataSource] = TwoPhase, **options: str) -> StreamingQuery:
    """Start a stream whose records appear in ``delivered`` exactly once, batch by batch."""
    spark = df.sparkSession
    spark.dataSource.register(format)
    query = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    Delivery(path, query)._open()  # so that readers find the folders
    return writer(df, checkpoint, **options).format(format.name()).option("path", path).option("query", query).start()


def delivered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records of committed batches."""
    committed = spark.read.schema(MANIFEST).json(f"{path}/{BATCHES}").select("part")
    records = spark.read.schema(schema).parquet(f"{path}/{PARTS}")
    return records.select("*", F.col("_metadata.file_name").alias("part")).join(committed, "part", "left_semi").select(
        *schema.names)


def forget_uncommitted(spark: SparkSession, path: str) -> int:
    """Deletes parts that no batch has committed, left by drivers that died; returns how many. Run it while no stream writes."""
    store, root = fs.FileSystem.from_uri(path)
    committed = spark.read.schema(MANIFEST).json(f"{path}/{BATCHES}").select("part")
    there = spark.read.format("binaryFile").load(f"{path}/{PARTS}").select(F.regexp_extract("path", "[^/]+$", 0).alias("part"))
    orphans = [r["part"] for r in there.join(committed, "part", "left_anti").toLocalIterator()]
    for part in orphans:
        store.delete_file(f"{root}/{PARTS}/{part}")
    return len(orphans)
