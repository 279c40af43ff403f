"""Sources, sinks and job parameters, up to the connectors that are not installed here."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater import __main__ as command
from tidewater import session
from tidewater.plans import jobs
from tidewater.sinks import documents, messages
from tidewater.sinks import tables as sinks
from tidewater.sources import jdbc
from tidewater.sources import messages as topics
from tidewater.sources import rows as files


def test_literal_and_text_sources(spark, tmp_path):
    frame = files.from_rows(spark, [("a", 1), (None, 2)], "value string, n int")
    sinks.append_lines(frame.where("value is not null"), f"{tmp_path}/lines")
    sinks.append_lines(files.from_rows(spark, [("b",)], "value string"), f"{tmp_path}/lines", single_file=True)
    assert rows(files.text_lines(spark, f"{tmp_path}/lines")) == [("a",), ("b",)]


def test_message_records(spark):
    frame = spark.createDataFrame([("click", 1), ("", 2)], "k string, n int")
    sent = messages.records(frame, F.to_json(F.struct("k", "n")), key=F.col("k"), partitions=7, identity=["n"])
    assert sent.columns == ["value", "key", "partition", "headers"]
    got = rows(sent.select("value", "key", "partition"))
    assert got == [('{"k":"","n":2}', "", 0), ('{"k":"click","n":1}', "click", 6)]
    ids = [r[0] for r in sent.select(F.col("headers")[0]["value"]).collect()]
    assert len(set(map(bytes, ids))) == 2
    fixed = messages.records(frame, F.col("n"), partition=1)
    assert rows(fixed) == [("1", 1), ("2", 1)]
    with pytest.raises(ValueError):
        messages.records(frame, F.col("n"), partitions=3)


def test_producer_options():
    options = messages.producer_options("h:1", "t", kafka__retries="9")
    assert options == {
        "kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.acks": "-1", "kafka.enable.idempotence": "true",
        "kafka.retries": "9", "kafka.max.in.flight.requests.per.connection": "1"}


def test_consumer_options():
    assert topics.consumer_options("h:1", topic="t") == {
        "kafka.bootstrap.servers": "h:1", "startingOffsets": "latest", "subscribe": "t"}
    assert topics.consumer_options("h:1", pattern="t.*", reset="earliest", most_per_batch=10)["subscribePattern"] == "t.*"
    with pytest.raises(ValueError):
        topics.consumer_options("h:1")
    with pytest.raises(ValueError):
        topics.consumer_options("h:1", topic="t", reset="sometime")


def test_properties():
    text = "# comment\nbootstrap.servers=h:1\ngroup.id = g\n\nauto.offset.reset=earliest\ntopic_name=t\n"
    text += "host=db\nport=3306\ndatabase=d\nusername=u\npassword=p=q\n"
    properties = session.read_properties(text)
    assert topics.options_from_properties(properties) == {
        "kafka.bootstrap.servers": "h:1", "startingOffsets": "earliest", "subscribe": "t", "groupIdPrefix": "g"}
    database = jdbc.options_from_properties(properties)
    assert database["url"].startswith("jdbc:mysql://db:3306/d?") and database["password"] == "p=q"
    assert database["query"] == jdbc.USER_INFO_QUERY
    split = jdbc.split_read(database, "userAge", 0, 100, 4)
    assert "query" not in split and split["dbtable"] == f"({jdbc.USER_INFO_QUERY}) t" and split["numPartitions"] == "4"
    assert session.read_arguments(["--port", "6789", "--flag", "-n", "-5"]) == {"port": "6789", "flag": "true", "n": "-5"}
    with pytest.raises(ValueError):
        session.read_arguments(["x"])


def test_shared_dir(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


class FlakyStore:
    """Takes a document at the second try, refuses bad ones, never takes busy ones."""

    def __init__(self, folder):
        self.folder, self.tried = folder, {}

    def __call__(self, index, docs):
        return [self.answer(index, *doc) for doc in docs]

    def answer(self, index, identity, source):
        self.tried[identity] = self.tried.get(identity, 0) + 1
        if source == "bad":
            return "parse error"
        if source == "busy" or self.tried[identity] < 2:
            return "rejected" if self.tried[identity] % 2 else "timeout"
        with open(f"{self.folder}/{index}-{identity}", "w") as out:
            out.write(source)
        return "ok"


def test_index_documents(spark, tmp_path):
    data = [(i, "bad" if i == 3 else "busy" if i == 5 else f'{{"n":{i}}}') for i in range(10)]
    frame = spark.createDataFrame(data, "i int, body string")
    docs = documents.documents(frame, F.col("i"), F.col("body"))
    folder = str(tmp_path)
    left = documents.index_documents(docs, "product", lambda: FlakyStore(folder), bulk_size=2, tries=3, pause_seconds=0)
    assert rows(left) == [("3", "bad", "parse error"), ("5", "busy", "rejected")]
    assert sorted(p.name for p in tmp_path.glob("product-*")) == sorted(f"product-{i}" for i in range(10) if i not in (3, 5))


def test_documents_override_and_last(spark):
    frame = spark.createDataFrame([(1, '{"eventType":"x","n":1}', 1), (1, '{"n":2}', 2)], "i int, body string, at int")
    docs = documents.documents(frame, F.col("i"), F.col("body"), F.lit("product"))
    assert rows(docs) == [("1", '{"n":1,"eventType":"product"}'), ("1", '{"n":2,"eventType":"product"}')]
    named = frame.select(F.col("i").cast("string").alias("id"), F.col("body").alias("source"), "at")
    assert rows(documents.last_per_id(named, "at")) == [("1", '{"n":2}', 2)]


def test_repeated_batch_changes_nothing(spark, tmp_path):
    table = sinks.LatestTable(str(tmp_path / "t"), ["k"], ["at"])
    first = spark.createDataFrame([("a", 1, 10), ("a", 2, 20)], "k string, at int, v int")
    second = spark.createDataFrame([("a", 2, 21), ("b", 1, 5)], "k string, at int, v int")
    for _ in range(2):
        table.write_batch(first, 0)
        table.write_batch(second, 1)
    assert rows(table.read(spark)) == [("a", 2, 21), ("b", 1, 5)]


def test_command_line(spark, tmp_path):
    with pytest.raises(SystemExit):
        command.main([])
    with pytest.raises(ValueError):
        command.start(spark, "nothing", {"checkpoint": "c"}, {})
    args = {"checkpoint": str(tmp_path), "topics": "t.*", "to": "out", "browse": "b", "click": "c", "out": str(tmp_path)}
    properties = {"bootstrap.servers": "h:1", "topic_name": "t", "host": "db", "port": "1", "database": "d",
                  "username": "u", "password": "p"}
    for job in ("page_views", "user_counts", "join_logs", "enrich"):
        with pytest.raises(Exception, match="kafka"):
            command.start(spark, job, args, properties)


@pytest.mark.parametrize("job", ["count_words", "count_words_sql"])
def test_batch_jobs(spark, tmp_path, job):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("hello,world\nhello,,\n")
    command.run_once(spark, job, {"folder": f"{tmp_path}/in", "out": f"{tmp_path}/out"})
    assert rows(spark.read.schema("word string, n bigint").csv(f"{tmp_path}/out")) == [("hello", 2), ("world", 1)]


def test_sliced_user_counts(spark, tmp_path):
    """Every line is counted or rejected, a repeated batch changes nothing, and a hot user is in several slices."""
    def lines(first, *users):
        text = [f'{{"userID": "{u}", "eventTime": "2024-01-01 10:00:00", "eventType": "x", "productID": 1}}' if u else "broken"
                for u in users]
        return spark.createDataFrame([(v, first + i) for i, v in enumerate(text)], "value string, offset bigint")

    handle = jobs.user_counts_batches(f"{tmp_path}/totals", ["offset"], sinks.append_batch(f"{tmp_path}/out"),
                                      sinks.append_batch(f"{tmp_path}/rejected"), slices=4)
    batches = [lines(0, *["hot"] * 40, None, "cold"), lines(42, "hot", None, "cold", "new")]
    for number, part in [(0, batches[0]), (1, batches[1]), (1, batches[1])]:
        handle(part, number)
    expected = [f"hot : {i}" for i in range(1, 42)] + ["cold : 1", "cold : 2", "new : 1"]
    assert sorted(r["value"] for r in sinks.read_batches(spark, f"{tmp_path}/out").collect()) == sorted(expected)
    lost = sinks.read_batches(spark, f"{tmp_path}/rejected")
    assert rows(lost.select("value", "offset")) == [("broken", 40), ("broken", 43)]
