"""State that moves to a query with another number of stores; hot keys of stream joins."""

from collections import Counter
from datetime import datetime
from statistics import median

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import joins
from tidewater.streaming import processors, rescaling
from tidewater.streaming.ending import Ending
from tidewater.streaming.queries import finish, state_partitions, to_files

FIRST = [("a", "x", 1), ("a", "y", 2), ("b", "x", 3), (None, None, 4), ("a", "x", 5)]
SECOND = [("a", "x", 10), ("c", "x", 20), (None, None, 30), ("b", "y", 40)]
ROW = "user string, item string, amount bigint"


def run(spark, place, some, stores, build, initial=None):
    """One query over its own folder and checkpoint; its result and its checkpoint."""
    spark.createDataFrame(some, ROW).coalesce(1).write.parquet(f"{place}/in")
    stream = build(spark.readStream.schema(ROW).parquet(f"{place}/in"), initial)
    with state_partitions(spark, stores):
        query = finish(to_files(stream, f"{place}/out", f"{place}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{place}/out"), f"{place}/checkpoint", query


@pytest.mark.parametrize("build,variable,items,expected", [
    (lambda s, i: processors.running_sum(s, ["user"], "amount", initial=i).select("user", "total"), "total", None,
     [("a", 18), ("c", 20), (None, 34), ("b", 43)]),
    (lambda s, i: processors.count_per_item(s, ["user"], "item", initial=i).select("user", "item", "n"), "counts", "item",
     [("a", "x", 3), ("c", "x", 1), (None, None, 2), ("b", "y", 1)]),
    (lambda s, i: processors.count_changes(s, "user", initial=i).where("is_add").select("user", "n"), "n", None,
     [("a", 4), ("c", 1), (None, 2), ("b", 2)]),
])
def test_another_number_of_stores(spark, tmp_path, build, variable, items, expected):
    _, checkpoint, query = run(spark, tmp_path / "old", FIRST, 2, build)
    assert rescaling.input_position(query) is not None
    kept = rescaling.kept_state(spark, checkpoint, variable, items)
    found, grown, _ = run(spark, tmp_path / "new", SECOND, 5, build, kept)
    assert rows(found) == sorted(expected, key=repr)
    numbers = spark.read.format("state-metadata").load(grown).select("numPartitions").distinct()
    assert rows(numbers) == [(5,)]


def test_open_pairs_go_along(spark, tmp_path):
    def build(stream, initial):
        return processors.pair_average(stream.select(F.length("item").cast("bigint").alias("k"), "amount"), "k", "amount",
                                       initial=initial)

    _, checkpoint, _ = run(spark, tmp_path / "old", [("a", "x", 2), ("a", "x", 4), ("a", "x", 10)], 2, build)
    found, _, _ = run(spark, tmp_path / "new", [("a", "x", 20)], 3, build, rescaling.kept_state(spark, checkpoint, "open_pair"))
    assert rows(found) == [(1, 15)]


def test_keys_without_new_rows_are_kept(spark, tmp_path):
    """A second move still has them."""
    def build(stream, initial):
        return processors.running_sum(stream, ["user"], "amount", initial=initial)

    _, first, _ = run(spark, tmp_path / "1", FIRST, 2, build)
    _, second, _ = run(spark, tmp_path / "2", [("z", "x", 1)], 4, build, rescaling.kept_state(spark, first, "total"))
    kept = rescaling.kept_state(spark, second, "total")
    assert rows(kept) == sorted([("a", 8), ("b", 3), (None, 4), ("z", 1)], key=repr)


def test_totals_in_parts_move(spark, tmp_path):
    """A state for each part instead of each key; from keys to parts, to another number of parts, and back to keys."""
    def build(parts):
        def stream(df, initial):
            numbered = df.withColumn("number", F.when(F.col("user").isNotNull(), F.ascii("user") + F.lit(2**60)))
            return processors.running_sum(numbered, ["user", "number"], "amount", initial=initial, parts=parts).select(
                "user", "number", "total")
        return stream

    big, kept, found = 2**60, None, {}
    some = [FIRST, [*SECOND, *((f"u{i}", "x", i) for i in range(50)), ("u7", "x", 1)], FIRST, SECOND]
    for n, (rows_in, parts) in enumerate(zip(some, (None, 2, 5, None), strict=True)):
        found[n], checkpoint, _ = run(spark, tmp_path / str(n), rows_in, 2 + n, build(parts), kept)
        kept = rescaling.kept_state(spark, checkpoint, "total")
        if parts:
            states = spark.read.format("statestore").option("stateVarName", "total").load(checkpoint)
            assert states.select("key").distinct().count() <= parts < kept.count()
    assert {("u7", 7, big + ord("u")), ("u7", 8, big + ord("u")), ("a", 18, big + 97), (None, 34, None)} <= {
        (r["user"], r["total"], r["number"]) for r in found[1].collect()}
    assert rows(found[3]) == sorted([("a", big + 97, 36), ("c", big + 99, 40), (None, None, 68), ("b", big + 98, 86)], key=repr)
    assert kept.count() == 54


def test_topic_goes_on_where_the_old_query_stopped():
    options = {"subscribe": "t", "startingOffsets": "earliest"}
    assert rescaling.topic_from(options, None) == options
    assert rescaling.topic_from(options, '{"t":{"0":5}}')["startingOffsets"] == '{"t":{"0":5}}'


LOG = "ts timestamp, user string, id bigint"


def logs(n, users):
    return [(datetime(2024, 1, 1, 10), users(i), i) for i in range(n)]


def frames(spark):
    left = logs(2000, lambda i: "hot" if i % 2 else f"u{i % 400}")
    right = logs(12, lambda i: "hot" if i % 3 == 0 else f"u{i * 2}") + [(datetime(2024, 1, 1, 10), "alone", 99)]
    return spark.createDataFrame(left, LOG), spark.createDataFrame(right, LOG)


@pytest.mark.parametrize("how", ["inner", "left", "right"])
@pytest.mark.parametrize("hot", [None, [("hot",)], []])
def test_salted_joins_give_the_same_rows(spark, how, hot):
    sides = frames(spark)
    plain = rows(joins.window_join(*sides, how, "ts", "1 hour", ["user"]))
    assert rows(joins.window_join(*sides, how, "ts", "1 hour", ["user"], salts=7, hot=hot)) == plain
    if how == "inner":
        assert rows(joins.window_join(*sides, how, "ts", "1 hour", ["user"], salts=7, salted="right", hot=hot)) == plain


def test_only_the_whole_side_of_an_outer_join_is_salted(spark):
    with pytest.raises(ValueError, match="left side"):
        joins.window_join(*frames(spark), "left", "ts", "1 hour", ["user"], salts=2, salted="right")
    with pytest.raises(ValueError, match="a value for each"):
        joins.window_join(*frames(spark), "left", "ts", "1 hour", ["user"], salts=2, hot=[("a", "b")])


def test_hot_keys(spark):
    left, _ = frames(spark)
    assert joins.hot_keys(left, ["user"], 0.1) == [("hot",)]
    assert joins.hot_keys(left.limit(0), ["user"]) == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_hot_key_of_a_stream_is_spread(spark, tmp_path, how):
    """Half of the rows have one key, and no task has more than twice the median."""
    for side, frame in zip(("l", "r"), frames(spark), strict=True):
        frame.coalesce(1).write.parquet(f"{tmp_path}/{side}")

    def counts(place, **salts):
        ending = Ending(spark, f"{tmp_path}/{place}/end")
        sides = [ending.timed(spark.readStream.schema(LOG).parquet(f"{tmp_path}/{s}"), "ts", "0 seconds") for s in "lr"]
        joined = joins.window_join(*sides, how, "ts", "1 hour", ["user"], **salts).withColumn("task", F.spark_partition_id())
        with state_partitions(spark, 4):
            ending.run(lambda: to_files(joined, f"{tmp_path}/{place}/out", f"{tmp_path}/{place}/checkpoint"))
        found = spark.read.schema(joined.schema).parquet(f"{tmp_path}/{place}/out")
        return rows(found.drop("task")), Counter(r["task"] for r in found.collect())

    plain, crowded = counts("plain")
    salted, spread = counts("salted", salts=64, hot=[("hot",)])
    assert salted == plain
    assert max(spread.values()) <= 2 * median(spread.values()) < max(crowded.values())
