"""Latest-value tables that are looked up by key."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.sinks.lookups import POINTER, LookupTable

ROW = "user string, at int, n bigint"


def batch(spark, *some):
    return spark.createDataFrame(list(some), ROW)


@pytest.fixture
def users(spark, tmp_path):
    return LookupTable(spark, f"{tmp_path}/users", ["user"], ["at"], buckets=8, fold_every=3)


def test_later_rows_and_later_batches_win(spark, users):
    users.write_batch(batch(spark, ("a", 1, 1), ("a", 2, 2), ("b", 5, 3), (None, 1, 4)), 0)
    users.write_batch(batch(spark, ("a", 2, 5), ("b", 4, 6), ("c", 1, 7)), 1)
    assert rows(users.read()) == sorted([("a", 2, 5), ("b", 5, 3), ("c", 1, 7), (None, 1, 4)], key=repr)
    assert rows(users.look_up(["a", None, "absent"])) == sorted([("a", 2, 5), (None, 1, 4)], key=repr)
    assert rows(users.look_up([])) == []


def test_a_lookup_opens_the_files_of_its_buckets(spark, users):
    names = [f"user-{i}" for i in range(200)]
    for number in range(2):
        users.write_batch(batch(spark, *[(n, number, i) for i, n in enumerate(names)]), number)
    assert len(users.read().inputFiles()) == 16
    found = users.look_up(names[:1])
    assert len(found.inputFiles()) == 2 and rows(found) == [("user-0", 1, 0)]
    wanted = {names[i] for i in (0, 1, 2)}
    buckets = spark.createDataFrame([(n,) for n in wanted], "user string").select(
        F.pmod(F.xxhash64("user"), F.lit(8))).distinct().count()
    assert len(users.look_up(wanted).inputFiles()) == 2 * buckets
    asked = spark.createDataFrame([(n,) for n in [*names[:3], "absent"]], "user string")
    assert rows(users.look_up_rows(asked).select("n")) == [(0,), (1,), (2,)]


def test_folds_remove_what_is_older(spark, users, tmp_path):
    for number in range(9):
        users.write_batch(batch(spark, (f"u{number}", number, number), ("all", number, number)), number)
        expected = sorted([(f"u{i}", i, i) for i in range(number + 1)] + [("all", number, number)], key=repr)
        assert rows(users.read()) == expected
    folders = [n for n in os.listdir(tmp_path / "users") if n.startswith("batch-")]
    assert len(folders) == 6  # those of the last fold but one and later: 3 to 8
    held = users.look_up(["all"])
    assert len(held.inputFiles()) <= 3


def test_a_repeated_batch_takes_the_place_of_its_first_attempt(spark, users, tmp_path):
    users.write_batch(batch(spark, ("a", 1, 1)), 0)
    users.write_batch(batch(spark, ("a", 2, 2), ("b", 1, 2)), 1)
    users.write_batch(batch(spark, ("a", 2, 3)), 1)
    assert rows(users.read()) == [("a", 2, 3)]
    assert len([n for n in os.listdir(tmp_path / "users") if n.startswith("batch-")]) == 2


def test_a_batch_that_failed_before_its_pointer_is_not_seen(spark, users, tmp_path, monkeypatch):
    users.write_batch(batch(spark, ("a", 1, 1)), 0)
    with monkeypatch.context() as broken:
        broken.setattr(users, "_point", lambda pointer: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            users.write_batch(batch(spark, ("a", 2, 2)), 1)
    assert rows(users.read()) == [("a", 1, 1)]
    users.write_batch(batch(spark, ("a", 2, 3)), 1)
    assert rows(users.read()) == [("a", 2, 3)]
    assert not [n for n in os.listdir(tmp_path / "users") if n.startswith("_")]
    assert (tmp_path / "users" / POINTER).is_file()


def test_nothing_written_yet(spark, users):
    with pytest.raises(ValueError, match="schema"):
        users.read()
    schema = batch(spark, ("a", 1, 1)).schema
    assert rows(users.read(schema)) == [] and rows(users.look_up(["a"], schema)) == []
    users.write_batch(spark.createDataFrame([], ROW), 0)
    assert rows(users.read()) == []


def test_the_number_of_buckets_is_fixed(spark, users):
    users.write_batch(batch(spark, ("a", 1, 1)), 0)
    with pytest.raises(ValueError, match="8 buckets"):
        LookupTable(spark, users.path, ["user"], ["at"], buckets=9).read()


def test_several_key_columns(spark, tmp_path):
    pairs = LookupTable(spark, f"{tmp_path}/pairs", ["user", "at"], ["n"], buckets=4)
    pairs.write_batch(batch(spark, ("a", 1, 1), ("a", 1, 3), ("a", 2, 2)), 0)
    assert rows(pairs.look_up([("a", 1)])) == [("a", 1, 3)]
