"""Counts that expire by event time."""

import random
from datetime import datetime, timedelta

from tests.conftest import rows
from tidewater.operators import running
from tidewater.streaming.ending import Ending
from tidewater.streaming.expiry import count_with_expiry
from tidewater.streaming.queries import finish, published_state, to_files

ROW = "id bigint, user string, ts timestamp"
START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def stream(spark, place):
    watched = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(f"{place}/in")
    ending = Ending(spark, f"{place}/end")
    return ending, count_with_expiry(ending.timed(watched, "ts", "0 seconds"), ["user"], "ts", "id", 60)


def add(spark, place, *some):
    spark.createDataFrame(list(some), ROW).coalesce(1).write.mode("append").parquet(f"{place}/in")


def result(spark, place):
    return spark.read.schema("id bigint, user string, n bigint").parquet(f"{place}/out")


def test_state_goes_without_a_later_row(spark, tmp_path):
    add(spark, tmp_path)
    ending, counted = stream(spark, tmp_path)

    def start():
        return to_files(counted, f"{tmp_path}/out", f"{tmp_path}/checkpoint")

    add(spark, tmp_path, (2, "a", at(10)), (1, "a", at(0)), (3, "b", at(11)))
    finish(start())
    assert rows(result(spark, tmp_path)) == [(1, "a", 1), (2, "a", 2), (3, "b", 1)]
    kept = published_state(spark, f"{tmp_path}/checkpoint", "count")
    assert rows(kept.select("key.user", "value.n")) == [("a", 2), ("b", 1)]
    add(spark, tmp_path, (4, "b", at(70)), (5, "a", at(5)), (6, "a", None))  # the second is late
    finish(start())
    kept = published_state(spark, f"{tmp_path}/checkpoint", "count")
    assert rows(kept.select("key.user", "value.n")) == [("b", 2)], "the last row of a has expired"
    add(spark, tmp_path, (7, "a", at(80)), (8, "b", at(130)), (9, "b", at(129)))
    ending.run(start)
    # A gap equal to the time to live has expired.
    assert rows(result(spark, tmp_path)) == [(1, "a", 1), (2, "a", 2), (3, "b", 1), (4, "b", 2), (7, "a", 1), (8, "b", 4), (9, "b", 3)]
    assert published_state(spark, f"{tmp_path}/checkpoint", "count").count() == 0


def test_equals_the_batch_form(spark, tmp_path):
    r = random.Random(8)
    some = []
    for part in range(3):  # the watermark does not pass a row before its file is there
        own = [(100 * part + i, r.choice(["a", "b", None]), at(700 * part + r.choice([0, 61, 125, 400]) + r.randint(0, 250)))
               for i in range(100)]
        some += own
        add(spark, tmp_path, *own)
    ending, counted = stream(spark, tmp_path)
    ending.run(lambda: to_files(counted, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    got = {row["id"]: row["n"] for row in result(spark, tmp_path).collect()}
    table = spark.createDataFrame(some, ROW)
    batch = running.running_count_with_expiry(table, ["user"], ["ts", "id"], "ts", "60 seconds", slices=20)
    wanted = {row["id"]: row["n"] for row in batch.collect()}
    assert got == wanted and len(wanted) == 300


def test_keys_in_parts(spark, tmp_path):
    """The same counts with a state for each part instead of each key, also with expired counts and null keys."""
    r = random.Random(9)
    some = []
    for part in range(3):
        own = [(100 * part + i, r.choice([f"u{k}" for k in range(40)] + [None]), at(700 * part + r.randint(0, 650))) for i in range(100)]
        own += [(1000 + 100 * part + i, "hot", at(700 * part + 6 * i + i // 50 * 60)) for i in range(100)]
        some += own
        add(spark, tmp_path, *own)
    watched = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    ending = Ending(spark, f"{tmp_path}/end")
    counted = count_with_expiry(ending.timed(watched, "ts", "0 seconds"), ["user"], "ts", "id", 60, parts=3)

    def start():
        return to_files(counted, f"{tmp_path}/out", f"{tmp_path}/checkpoint")

    finish(start())
    kept = published_state(spark, f"{tmp_path}/checkpoint", "count")
    assert kept.count() > 3 and kept.select("key").distinct().count() <= 3
    ending.run(start)
    got = {row["id"]: (row["user"], row["n"]) for row in result(spark, tmp_path).collect()}
    table = spark.createDataFrame(some, ROW)
    batch = running.running_count_with_expiry(table, ["user"], ["ts", "id"], "ts", "60 seconds", slices=20)
    wanted = {row["id"]: (row["user"], row["n"]) for row in batch.collect()}
    assert got == wanted and len(wanted) == 600
    assert published_state(spark, f"{tmp_path}/checkpoint", "count").count() == 0
    assert published_state(spark, f"{tmp_path}/checkpoint", "waiting").count() == 0
