"""Exactly-once delivery, with batches that stop at the worst moments."""

import os

import pytest

from tests.conftest import rows
from tidewater.sinks.two_phase import BATCHES, PARTS, Delivery, TwoPhase, deliver, delivered, forget_uncommitted
from tidewater.sources.rows import watch_lines
from tidewater.streaming.queries import finish


class StopsBeforeCommit(Delivery):
    def commit(self, messages, batchId):
        os._exit(1)

    def abort(self, messages, batchId):
        os._exit(1)  # nothing is taken away either


class StopsAfterCommit(Delivery):
    def commit(self, messages, batchId):
        super().commit(messages, batchId)
        raise RuntimeError("stopped before Spark has noted the batch")


class Before(TwoPhase):
    @classmethod
    def name(cls):
        return "stops_before"

    def streamWriter(self, schema, overwrite):
        return StopsBeforeCommit(self.options["path"], self.options["query"])


class After(TwoPhase):
    @classmethod
    def name(cls):
        return "stops_after"

    def streamWriter(self, schema, overwrite):
        return StopsAfterCommit(self.options["path"], self.options["query"])


@pytest.mark.parametrize("stop", [Before, After])
def test_a_stopped_batch_leaves_and_repeats_nothing(spark, lines, tmp_path, stop):
    folder, drop = lines
    stream, path, checkpoint = watch_lines(spark, folder), f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    drop("a", "b", "b")
    finish(deliver(stream, path, checkpoint))
    assert rows(delivered(spark, path, stream.schema)) == [("a",), ("b",), ("b",)]
    drop("c", "d")
    with pytest.raises(Exception):  # noqa: B017
        finish(deliver(stream, path, checkpoint, format=stop))
    seen = [("a",), ("b",), ("b",)] + ([("c",), ("d",)] if stop is After else [])
    assert rows(delivered(spark, path, stream.schema)) == seen
    drop("e")
    finish(deliver(stream, path, checkpoint))
    assert rows(delivered(spark, path, stream.schema)) == [("a",), ("b",), ("b",), ("c",), ("d",), ("e",)]
    assert forget_uncommitted(spark, path) == (1 if stop is Before else 0)
    assert forget_uncommitted(spark, path) == 0
    assert rows(delivered(spark, path, stream.schema)) == [("a",), ("b",), ("b",), ("c",), ("d",), ("e",)]


def test_two_streams_into_one_place(spark, lines, tmp_path):
    folder, drop = lines
    drop("a")
    stream, path = watch_lines(spark, folder), f"{tmp_path}/out"
    finish(deliver(stream, path, f"{tmp_path}/one"))
    finish(deliver(stream, path, f"{tmp_path}/two"))
    finish(deliver(stream, path, f"{tmp_path}/two"))
    assert rows(delivered(spark, path, stream.schema)) == [("a",), ("a",)]
    assert len(os.listdir(f"{path}/{PARTS}")) == 2 and len(os.listdir(f"{path}/{BATCHES}")) == 2
    empty = watch_lines(spark, folder).where("value = 'absent'")
    finish(deliver(empty, f"{tmp_path}/none", f"{tmp_path}/three"))
    assert delivered(spark, f"{tmp_path}/none", stream.schema).collect() == []
