"""Finite streams that end, and co-groups delivered by them."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import joins, windows
from tidewater.streaming import cogroups
from tidewater.streaming.ending import END_OF_TIME, Ending
from tidewater.streaming.queries import finish, published_state, to_files

ROW = "ts timestamp, user string, id bigint"


def at(second):
    return datetime(2024, 1, 1, 10, 0, second)


class Folder:
    """A folder watched by a stream of rows."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)
        self.add()

    def add(self, *some):
        self.spark.createDataFrame(list(some), ROW).coalesce(1).write.mode("append").parquet(self.path)

    def read(self):
        return self.spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(self.path)


def start(stream, place):
    return lambda: to_files(stream, f"{place}/out", f"{place}/checkpoint")


def result(stream, place):
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{place}/out")


def test_last_windows_come_out(spark, tmp_path):
    source = Folder(spark, tmp_path / "in")
    source.add((at(1), "a", 1), (at(12), "a", 2))
    ending = Ending(spark, f"{tmp_path}/end")
    counted = windows.window_sum(ending.timed(source.read(), "ts", "3 seconds"), "ts", "10 seconds", "user", F.col("id"))
    begin = start(counted, tmp_path)
    finish(begin())
    assert rows(result(counted, tmp_path).select("total")) == []
    source.add((at(25), "a", 4), (None, "a", 100), (END_OF_TIME, "a", 100))
    ending.run(begin)
    assert ending.ended() and rows(result(counted, tmp_path).select("total")) == [(1,), (2,), (4,)]
    # Ended for good: a repeated run changes nothing, and what comes later is late.
    source.add((at(58), "a", 8))
    ending.run(begin)
    Ending(spark, f"{tmp_path}/end").run(begin)
    assert rows(result(counted, tmp_path).select("total")) == [(1,), (2,), (4,)]


def test_a_failure_before_the_last_windows(spark, tmp_path):
    """The marker is written, but the run that brings out the rest did not come."""
    source = Folder(spark, tmp_path / "in")
    source.add((at(1), "a", 1))
    ending = Ending(spark, f"{tmp_path}/end")
    counted = windows.window_sum(ending.timed(source.read(), "ts", "0 seconds"), "ts", "10 seconds", "user", F.col("id"))
    begin = start(counted, tmp_path)
    finish(begin())
    ending.end()
    ending.run(begin)
    assert rows(result(counted, tmp_path).select("total")) == [(1,)]


@pytest.mark.parametrize("how", ["left", "right"])
def test_rows_without_a_match_come_out(spark, tmp_path, how):
    left, right = Folder(spark, tmp_path / "l"), Folder(spark, tmp_path / "r")
    left.add((at(1), "a", 1), (at(50), "a", 2))
    right.add((at(1), "a", 3), (at(2), "b", 4))
    ending = Ending(spark, f"{tmp_path}/end")
    sides = [ending.timed(f.read().withColumn("second", F.date_format("ts", "ss")), "ts", "0 seconds") for f in (left, right)]
    joined = joins.window_join(*sides, how, "ts", "10 seconds", ["user", "second"]).select("left_id", "right_id")
    ending.run(start(joined, tmp_path))
    assert rows(result(joined, tmp_path)) == sorted([(1, 3), (2, None) if how == "left" else (None, 4)], key=repr)


def group_stream(spark, tmp_path, **options):
    left, right = Folder(spark, tmp_path / "l"), Folder(spark, tmp_path / "r")
    ending = Ending(spark, f"{tmp_path}/end")
    members = joins.cogroup_rows(*[ending.timed(f.read(), "ts", "0 seconds") for f in (left, right)], "ts", "10 seconds",
                                 ["user"], F.col("id"), F.col("id"))
    return left, right, ending, cogroups.delivered_groups(members, ["user"], **options)


def test_groups_are_delivered_when_their_window_closes(spark, tmp_path):
    left, right, ending, groups = group_stream(spark, tmp_path)
    begin = start(groups, tmp_path)
    left.add((at(1), "a", 1), (at(3), None, 2), (at(4), "a", None))
    right.add((at(2), "a", 3))
    finish(begin())
    left.add((at(12), "b", 5), (at(15), "c", 6))
    finish(begin())
    assert result(groups, tmp_path).count() == 0, "the right side may still send rows"
    left.add((at(16), "c", 9))
    right.add((at(14), "b", 4))
    finish(begin())
    first = [("a", "left", 2, 1, 1), ("a", "left", 2, 1, None), ("a", "right", 2, 1, 3), (None, "left", 1, 0, 2)]
    shown = ["user", "side", "n_left", "n_right", "payload"]
    assert rows(result(groups, tmp_path).select(*shown)) == sorted(first, key=repr)
    left.add((at(5), "a", 7))  # late
    right.add((at(33), "a", 8))
    ending.run(begin)
    later = [("b", "left", 1, 1, 5), ("b", "right", 1, 1, 4), ("c", "left", 2, 0, 6), ("c", "left", 2, 0, 9), ("a", "right", 0, 1, 8)]
    got = result(groups, tmp_path)
    assert rows(got.select(*shown)) == sorted(first + later, key=repr)
    places = got.where("user = 'a' AND n_left = 2").orderBy("place").select("place", "side", "window_start", "window_end")
    assert [tuple(r) for r in places.collect()] == [
        (1, "left", at(0), at(10)), (2, "left", at(0), at(10)), (3, "right", at(0), at(10))]


def test_groups_larger_than_a_chunk(spark, tmp_path):
    left, right, ending, groups = group_stream(spark, tmp_path, chunk=16)
    left.add(*[(at(1), "a", i) for i in range(500)])
    right.add(*[(at(2), "a", i) for i in range(33)])
    begin = start(groups, tmp_path)
    finish(begin())
    left.add(*[(at(3), "a", 500 + i) for i in range(100)])
    ending.run(begin)
    got = result(groups, tmp_path).orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(1, 634)) and {(r["n_left"], r["n_right"]) for r in got} == {(600, 33)}
    assert sorted(r["payload"] for r in got[:600]) == list(range(600)) and [r["side"] for r in got[600:]] == ["right"] * 33
    assert max(r["payload"] for r in got[:500]) == 499, "in the order of arrival"


def test_hot_groups_in_parts(spark, tmp_path):
    left, right, ending, groups = group_stream(spark, tmp_path, shards=4)
    left.add(*[(at(1), "a", i) for i in range(200)])
    right.add((at(1), "a", 1))
    ending.run(start(groups, tmp_path))
    got = result(groups, tmp_path).collect()
    assert sorted(r["payload"] for r in got) == sorted([*range(200), 1]) and len({r["shard"] for r in got}) == 4
    for shard in range(4):
        part = [r for r in got if r["shard"] == shard]
        assert sorted(r["place"] for r in part) == list(range(1, len(part) + 1))


def test_many_small_groups_are_few_parts(spark, tmp_path):
    """A call handles a part of a window, not a group: so many states wait as there are parts, however many groups."""
    left, right, ending, groups = group_stream(spark, tmp_path, parts=4, chunk=50)
    left.add(*[(at(1), f"u{i % 300}", i) for i in range(600)], (at(1), None, 600))
    right.add(*[(at(2), f"u{i}", i) for i in range(150)])
    begin = start(groups, tmp_path)
    finish(begin())
    assert published_state(spark, f"{tmp_path}/checkpoint", "sizes").count() == 4
    ending.run(begin)
    got = result(groups, tmp_path)
    assert got.count() == 751 and got.where("place > n_left + n_right OR (side = 'left') <> (place <= n_left)").isEmpty()
    assert rows(got.groupBy("user", "n_left", "n_right").count().groupBy("n_left", "n_right", "count").agg(F.count("*"))) == [
        (1, 0, 1, 1), (2, 0, 2, 150), (2, 1, 3, 150)]
    assert got.select("user", "place").distinct().count() == 751
    assert published_state(spark, f"{tmp_path}/checkpoint", "sizes").count() == 0


def test_keys_of_other_types_come_back(spark, tmp_path):
    left, right = Folder(spark, tmp_path / "l"), Folder(spark, tmp_path / "r")
    keys = {"big": F.col("id") + F.lit(2**60), "day": F.to_date("ts"), "moment": F.expr("ts + INTERVAL 7 MICROSECOND"),
            "part": F.when(F.col("id") == 1, F.lit(0.1).cast("float")), "raw": F.encode("user", "utf-8")}
    ending = Ending(spark, f"{tmp_path}/end")
    sides = [ending.timed(f.read().withColumns(keys), "ts", "0 seconds") for f in (left, right)]
    members = joins.cogroup_rows(*sides, "ts", "10 seconds", [*keys], F.col("id"), F.col("id"))
    groups = cogroups.delivered_groups(members, [*keys], parts=1)
    some = [(at(1), "a", 1), (at(1), None, None)]
    left.add(*some)
    right.add(*some)
    ending.run(start(groups, tmp_path))
    wanted = spark.createDataFrame(some, ROW).select(*[c.alias(n) for n, c in keys.items()])
    got = result(groups, tmp_path)
    assert got.select(*keys).schema.simpleString() == wanted.schema.simpleString()
    assert rows(got.where("n_left = 1 AND n_right = 1 AND side = 'left'").select(*keys)) == rows(wanted)
