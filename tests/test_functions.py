"""Column expressions against known values and against models in plain Python."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.functions import display, hashing, text, times
from tidewater.functions import json as js

FEW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def values(spark, inputs, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("v"))).collect()]


def split_model(value, pattern):
    pieces = re.split(pattern, value)
    if len(pieces) == 1:
        return pieces
    while pieces and pieces[-1] == "":
        pieces.pop()
    return pieces


def hash_model(value):
    units = value.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (h * 31 + int.from_bytes(units[i:i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def test_split_known(spark):
    inputs = ["scala,", ",", "a,,b", ",aaaa", "", "a", ",,x,,", "a,\n", ",\n"]
    assert values(spark, inputs, lambda v: text.split_on(v, ",")) == [
        ["scala"], [], ["a", "", "b"], ["", "aaaa"], [""], ["a"], ["", "", "x"], ["a", "\n"], ["", "\n"]]
    assert values(spark, [None], lambda v: text.split_on(v, ",")) == [None]


@FEW
@given(st.lists(st.text(alphabet="a,|\n é", max_size=12), min_size=1, max_size=150))
def test_split_model(spark, inputs):
    assert values(spark, inputs, lambda v: text.split_on(v, ",")) == [split_model(v, ",") for v in inputs]
    assert values(spark, inputs, lambda v: text.split_on(v, "|")) == [split_model(v, r"\|") for v in inputs]


@FEW
@given(st.lists(st.text(alphabet="ab_ ,.\n", max_size=12), min_size=1, max_size=150))
def test_split_pattern_model(spark, inputs):
    got = values(spark, inputs, lambda v: text.split_pattern(v, "\\W+"))
    assert got == [split_model(v, r"\W+") for v in inputs]


@FEW
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=8), min_size=1, max_size=150))
def test_string_hash_model(spark, inputs):
    assert values(spark, inputs, hashing.string_hash) == [hash_model(v) for v in inputs]


def test_string_hash_known(spark):
    assert values(spark, ["", "a", "hello", "polygenelubricants"], hashing.string_hash) == [0, 97, 99162322, -(1 << 31)]
    assert values(spark, ["", "polygenelubricants", None], lambda v: hashing.hash_partition(v, 7)) == [0, (1 << 31) % 7, None]


def test_numbers(spark):
    assert values(spark, ["7", "+7", "-7", " 7", "7x", "", "99999999999999999999"], text.parse_long) == [
        7, 7, -7, None, None, None, None]
    assert values(spark, ["2147483647", "2147483648"], text.parse_int) == [2147483647, None]
    assert values(spark, [7, -7], lambda v: text.whole_mean(v, F.lit(2)), "bigint") == [3, -3]


def test_trim(spark):
    assert values(spark, ["\t a b\r\n", "\x00x\x1f", "   "], text.trim_controls) == ["a b", "x", ""]


def test_join_fields_keeps_nulls(spark):
    assert values(spark, [None, "x"], lambda v: text.join_fields("|", v, F.lit(1))) == ["null|1", "x|1"]


def test_rejoin(spark):
    assert values(spark, ["productID3:click:user_1", "a:b", "a", "a:"], text.rejoin_first_two) == [
        "productID3>>click", "a>>b", None, None]


@pytest.mark.parametrize("value, expected", [
    (0, "0KB"), (1536, "1.5KB"), (1024, "1KB"), (1024**2 - 1, "1024KB"), (1024**2, "1MB"), (8192000000, "7.63GB"),
    (1024**4, "1TB"), (5 * 1024**5, "5120TB")])
def test_format_bytes(spark, value, expected):
    assert values(spark, [value], display.format_bytes, "bigint") == [expected]


def test_shares(spark):
    assert values(spark, [0.12345, 0.5, 0.0, 1.0], display.format_share, "double") == ["12.35%", "50%", "0%", "100%"]
    assert values(spark, [3], lambda v: display.used_share(F.lit(8), v), "bigint") == ["62.5%"]


def test_record_text(spark):
    row = spark.createDataFrame([("u", "t", "click", None)], "userID string, eventTime string, eventType string, pageID string")
    assert row.select(display.click_text()).first()[0] == (
        "UserClickLog{userID='u', eventTime='t', eventType='click', pageID='null'}")


def test_times(spark):
    texts = ["2019-08-18 09:17:20", "2019-8-18 9:17:20", "2019-08-18", "x", "2019-02-30 00:00:00", None]
    got = values(spark, texts, lambda v: times.event_time_text(times.parse_event_time(v)))
    assert got == [texts[0], None, None, None, None, None]
    assert values(spark, [1614562657466], lambda v: times.event_time_text(times.millis_to_timestamp(v)), "bigint") == [
        "2021-03-01 01:37:37"]


JSON_TEXTS = ['{"a":"1","b":5}', '{"a":1', "[1,2]", "5", "", "null", '{"a":{"z":1},"b":"x"}', None, '{"b":1}{"b":2}',
              '{"a":1},{"a":2}', '{"a":"1"} tail', '{"a":"1"}]', '{"a":1}}', '  {"a":1} ', "{}"]


def test_json_fields(spark):
    got = values(spark, JSON_TEXTS, lambda v: js.json_fields(v, ["a", "b"]))
    assert [tuple(g) if g else None for g in got] == [
        ("1", "5"), None, None, None, None, None, ('{"z":1}', "x"), None, None, None, None, None, None, ("1", None),
        (None, None)]


def test_json_put(spark):
    got = values(spark, JSON_TEXTS + ['{"n":1,"o":{"p":[1,2]}}'], lambda v: js.json_put(v, "a", F.lit("new")))
    assert got == ['{"b":5,"a":"new"}', None, None, None, None, None, '{"b":"x","a":"new"}', None, None, None, None,
                   None, None, '{"a":"new"}', '{"a":"new"}', '{"n":1,"o":{"p":[1,2]},"a":"new"}']
