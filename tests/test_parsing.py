"""Text records: what is kept, what is rejected, and that nothing is lost."""

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.fixtures import HOST_LINE, PV_EVENTS
from tidewater import schemas
from tidewater.operators import parsing

BAD = [None, "", "not json", "[1]", "null", '{"userID":"u"} x', '{"userID":"a"},"r":{"userID":"b"}', '{"userID":"a"},"x":2',
       '{"userID":"a"}]', '{"userID":"a"}}]x', '{"userID":"a"},{"userID":"b"}', '{"userID":"a"},{"tidewater.seal":"1"}]x']


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def check_split(frame, parsed):
    assert parsed.kept.count() + parsed.rejected.count() == frame.count()


def test_events(spark):
    frame = lines(spark, PV_EVENTS + BAD)
    parsed = parsing.parse_event_json(frame)
    assert parsed.kept.schema == schemas.EVENT
    assert parsed.kept.count() == len(PV_EVENTS)
    assert rows(parsed.rejected) == sorted([(v,) for v in BAD], key=repr)


def test_int_members(spark):
    frame = lines(spark, ['{"userID":"a","productID":"5"}', '{"userID":"b"}', '{"userID":"c","productID":"x"}',
                          '{"userID":"d","productID":null}'])
    short = parsing.parse_event_json(frame)
    assert rows(short.kept.select("userID", "productID")) == [("a", 5), ("b", None), ("d", None)]
    assert rows(short.rejected) == [('{"userID":"c","productID":"x"}',)]
    zero = parsing.parse_event_json(frame, missing_int=0, bad_int="null")
    assert rows(zero.kept.select("userID", "productID")) == [("a", 5), ("b", 0), ("c", None), ("d", 0)]
    check_split(frame, short)
    check_split(frame, zero)


def test_logs(spark):
    frame = lines(spark, ['{"userID":"u","eventTime":"t","eventType":"browse","productID":"p","productPrice":10}'] + BAD)
    parsed = parsing.parse_json_records(frame, schemas.BROWSE_LOG)
    assert rows(parsed.kept) == [("u", "t", "browse", "p", 10)]
    check_split(frame, parsed)


def test_dynamic(spark):
    frame = lines(spark, ['{"a":1,"b":{"c":[true]}}', "{}"] + BAD)
    parsed = parsing.parse_dynamic_json(frame)
    assert rows(parsed.kept.select(F.to_json("members"))) == [('{"a":1,"b":{"c":[true]}}',), ("{}",)]
    check_split(frame, parsed)


def test_csv_pairs(spark):
    frame = lines(spark, ["a,3", " a,7 ", "\tb,1,extra\r", ",5", "a", "a,x", "a, 7", "", None])
    parsed = parsing.parse_csv_pair(frame)
    assert rows(parsed.kept) == [("", 5), ("a", 3), ("a", 7), ("b", 1)]
    check_split(frame, parsed)


def test_host_metrics(spark):
    ten = "|".join(HOST_LINE.split("|")[:10])
    frame = lines(spark, [HOST_LINE, ten, ten + "|", HOST_LINE.replace("|4|", "|four|"), HOST_LINE + "|more", ""])
    parsed = parsing.parse_host_metrics(frame, load_millis=F.lit(1))
    expected = (1, "Linux", None, 0.0, 4, "12.5%", "7.63GB", "40.1%", None, None, 1614562657466, "2021-3-1 10:37:37")
    assert rows(parsed.kept) == [expected, expected]
    assert parsed.kept.schema.simpleString() == schemas.HOST_METRICS.simpleString()
    check_split(frame, parsed)


def test_load_time_is_filled(spark):
    stamps = parsing.parse_host_metrics(lines(spark, [HOST_LINE])).kept.select("timeStamp").first()
    assert stamps[0] > 1_600_000_000_000
