"""Tables that change: as of an event's time, and polled as a stream."""

import json
import os
import time
from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import history
from tidewater.sinks import tables as sinks
from tidewater.sources.polled import polled_table
from tidewater.streaming.queries import finish, to_batches, to_files


def at(minute):
    return datetime(2024, 1, 1, 12, minute)


def people(spark, minute, *some):
    return history.snapshot(spark.createDataFrame(list(some), "user string, name string, age int"), at(minute))


def reads(spark):
    ann, bo = ("u1", "Ann", 30), ("u2", "Bo", None)
    return people(spark, 0, ann, bo).union(people(spark, 5, ann, bo, bo)).union(people(spark, 10, ("u1", "Ann", 31))).union(
        people(spark, 15, ("u1", "Ann", 31), bo, (None, "x", 1))).union(people(spark, 20, (None, None, None)))


def test_intervals(spark):
    got = history.intervals(reads(spark), ["user"]).select("user", "name", "age", F.minute("valid_from"), F.minute("valid_to"))
    assert rows(got) == [("u1", "Ann", 30, 0, 10), ("u1", "Ann", 31, 10, 20), ("u2", "Bo", None, 0, 10), ("u2", "Bo", None, 15, 20)]
    still = history.intervals(people(spark, 0, ("u1", "Ann", 30)), ["user"]).collect()
    assert [(r["user"], r["valid_to"]) for r in still] == [("u1", None)]
    assert history.intervals(reads(spark).limit(0), ["user"]).collect() == []


EVENTS = [(i, u, at(m)) for i, (u, m) in enumerate([("u1", 0), ("u2", 9), ("u2", 10), ("u1", 10), ("u2", 15), ("u1", 20), ("u3", 3),
                                                    (None, 3), ("u1", 59)])]
FOUND = [(0, "Ann", 30), (1, "Bo", None), (3, "Ann", 31), (4, "Bo", None)]


def test_as_of_batch_and_stream(spark, tmp_path):
    events = spark.createDataFrame(EVENTS, "id bigint, user string, ts timestamp")
    past = history.intervals(reads(spark), ["user"])
    assert rows(history.enrich_as_of(events, past, ["user"], "ts").select("id", "name", "age")) == FOUND
    events.write.parquet(f"{tmp_path}/events")
    reads(spark).write.parquet(f"{tmp_path}/reads")
    handle = history.enrich_as_of_batches(lambda: spark.read.parquet(f"{tmp_path}/reads"), ["user"], "ts",
                                          sinks.append_batch(f"{tmp_path}/out"))
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/events")
    finish(to_batches(stream, handle, f"{tmp_path}/checkpoint"))
    assert rows(sinks.read_batches(spark, f"{tmp_path}/out").select("id", "name", "age")) == FOUND


def test_polled_table(spark, tmp_path):
    """A restart goes on behind the last read; each key range is a task; what was deleted is gone from the next read."""
    table = str(tmp_path / "table.json")

    def store(some):
        with open(f"{table}.new", "w") as file:
            json.dump(some, file)
        os.replace(f"{table}.new", table)

    def read(low, high):
        from pyspark import TaskContext

        with open(table) as file:
            for key, name in json.load(file):
                if (low is None or key >= low) and (high is None or key < high):
                    yield key, name, TaskContext.get().partitionId()

    spark.dataSource.register(polled_table("polled_people", "id bigint, name string, task int", read, [10, 20], seconds=0.5))
    stream = spark.readStream.format("polled_people").load()

    def run():
        finish(to_files(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
        time.sleep(0.6)
        return spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")

    store([[1, "a"], [10, "b"], [25, "c"]])
    assert rows(run().select("id", "name", "task")) == [(1, "a", 0), (10, "b", 1), (25, "c", 2)]
    store([[1, "a"], [25, "d"]])
    found = run()
    numbers = [r[0] for r in found.select("read_number").distinct().orderBy("read_number").collect()]
    assert len(numbers) == 2 and rows(found.where(F.col("read_number") == numbers[1]).select("id", "name")) == [(1, "a"), (25, "d")]
    assert found.count() == 5
