"""The jobs: text lines in, results out.

Each job is a function from frames of ``value`` lines to a result frame, so the same job
runs on files, sockets and message topics, in batch where it needs no state of a stream.
``tidewater.__main__`` connects them to sources and sinks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions import display, json, text, times
from tidewater.operators import joins, parsing, tables, windows
from tidewater.sinks import documents, messages
from tidewater.streaming import carried, cogroups, processors

# Window widths and the delay allowed to late rows.
PV_WIDTH, PV_DELAY = "20 seconds", "3 seconds"
JOIN_WIDTH, JOIN_DELAY = "10 seconds", "0 seconds"
ARRIVAL_WIDTH = "5 seconds"
HOST_PARTITIONS = 3


def word_count(lines: DataFrame) -> DataFrame:
    """Comma-separated words of a batch, empty ones left out."""
    return tables.count_words(lines, text.split_on(F.col("value"), ","))


def word_count_sql(lines: DataFrame) -> DataFrame:
    """``word_count`` by SQL over a view of the words."""
    words = tables.words(lines, text.split_on(F.col("value"), ",")).withColumn("frequency", F.lit(1))
    return lines.sparkSession.sql("SELECT word, sum(frequency) AS frequency FROM {words} GROUP BY word", words=words)


def window_word_count(lines: DataFrame, arrival: str | None = None) -> DataFrame:
    """Words per five seconds of arrival; ``arrival`` names a time column to use instead of the clock."""
    if arrival is None:
        stamped, arrival = windows.with_ingest_time(lines), "ingest_ts"
    else:
        stamped = windows.with_event_time(lines, arrival, "0 seconds")
    pieces = text.split_on(F.col("value"), ",")
    words = tables.non_empty(stamped).select(arrival, F.explode(pieces).alias("word"))
    return windows.window_sum(words, arrival, ARRIVAL_WIDTH, "word", F.lit(1), "frequency")


def _events(lines: DataFrame, **options: object) -> DataFrame:
    return parsing.parse_event_json(tables.non_empty(lines), **options).kept


def user_counts(lines: DataFrame) -> DataFrame:
    """``user : n`` for every event of a stream."""
    ones = _events(lines, missing_int=0).select("userID", F.lit(1).cast("bigint").alias("one"))
    counted = processors.running_sum(ones, ["userID"], "one")
    return counted.select(F.concat_ws(" : ", "userID", "total").alias("value"))


def user_counts_batches(state_path: str, order: Sequence[str], write: Callable[[DataFrame, int], None],
                        rejected: Callable[[DataFrame, int], None], slices: int | None = None,
                        ) -> Callable[[DataFrame, int], None]:
    """``user_counts`` a micro-batch at a time, for lines that carry their ``order``: a hot user is cut into slices.

    ``write`` gets the counts as ``value``; ``rejected`` the lines no event could be read from. Every line is in one of both.
    """
    counts = carried.running_count_batches(
        state_path, ["userID"], order,
        lambda rows, batch_id: write(rows.select(F.concat_ws(" : ", "userID", "n").alias("value")), batch_id), slices=slices)

    def handle(lines: DataFrame, batch_id: int) -> None:
        parsed = parsing.parse_event_json(lines, missing_int=0, keep=tuple(order))
        counts(parsed.kept.select("userID", *order), batch_id)
        rejected(parsed.rejected.withColumn("rejected_at", times.load_time()), batch_id)

    return handle


def page_views(lines: DataFrame, width: str = PV_WIDTH, delay: str = PV_DELAY) -> DataFrame:
    """Events per window and type. An unreadable product number does not stop an event from counting."""
    timed = joins.log_times(_events(lines, bad_int="null"))
    return windows.page_views(windows.with_event_time(timed, "ts", delay), "ts", width)


def _log(lines: DataFrame, schema) -> DataFrame:
    parsed = parsing.parse_json_records(tables.non_empty(lines), schema).kept
    return windows.with_event_time(joins.log_times(parsed), "ts", JOIN_DELAY)


def join_logs(browse_lines: DataFrame, click_lines: DataFrame, how: str = "inner") -> DataFrame:
    """Browse and click events of one user in one second, as text pairs."""
    joined = joins.window_join(
        _log(browse_lines, schemas.BROWSE_LOG), _log(click_lines, schemas.CLICK_LOG), how, "ts", JOIN_WIDTH,
        ["userID", "eventTime"])
    return joins.render_join(joined, how)


def group_logs(browse_lines: DataFrame, click_lines: DataFrame) -> DataFrame:
    """Both sides' events as text, labelled with window, user, time and side."""
    return joins.cogroup_rows(
        _log(browse_lines, schemas.BROWSE_LOG), _log(click_lines, schemas.CLICK_LOG), "ts", JOIN_WIDTH,
        ["userID", "eventTime"], display.browse_text(), display.click_text())


def delivered_logs(browse_lines: DataFrame, click_lines: DataFrame) -> DataFrame:
    """The groups of ``group_logs`` of two streams, each delivered when its window has closed."""
    return cogroups.delivered_groups(group_logs(browse_lines, click_lines), ["userID", "eventTime"])


def events_to_enrich(lines: DataFrame) -> DataFrame:
    """Events for ``streaming.dimension.enrich_batches``."""
    return _events(lines, missing_int=0)


def _pairs(lines: DataFrame, arrival: str | None) -> tuple[DataFrame, str]:
    if arrival is None:
        stamped, arrival = windows.with_ingest_time(lines), "ingest_ts"
    else:
        stamped = windows.with_event_time(lines, arrival, "0 seconds")
    return parsing.parse_csv_pair(stamped, keep=(arrival,)).kept, arrival


def window_peaks(lines: DataFrame, arrival: str | None = None) -> DataFrame:
    """Largest ``pv`` per event and five seconds, to be published per event."""
    pairs, time = _pairs(lines, arrival)
    return windows.window_max(pairs, time, ARRIVAL_WIDTH, "event", F.col("pv"), "pv")


def window_counts(lines: DataFrame, arrival: str | None = None) -> DataFrame:
    """Count and sum of ``pv`` per event and five seconds, to be published per event."""
    pairs, time = _pairs(lines, arrival)
    return windows.window_count_sum(pairs, time, ARRIVAL_WIDTH, "event", F.col("pv"))


def host_messages(lines: DataFrame, form: str = "text", partitions: int = HOST_PARTITIONS,
                  load_millis: Column | None = None) -> DataFrame:
    """Metrics lines as messages: ``text`` keyed by itself and spread by key hash, or ``json``."""
    hosts = parsing.parse_host_metrics(lines, load_millis=load_millis).kept
    if form == "json":
        return messages.records(hosts, json.to_record(*hosts.columns))
    if form != "text":
        raise ValueError("form must be 'text' or 'json'")
    shown = hosts.select(display.host_text().alias("line"))
    return messages.records(shown, F.col("line"), key=F.col("line"), partitions=partitions)


def index_batches(index: str, identity: Column, connect: Callable[[], documents.Send],
                  dead_letter: Callable[[DataFrame, int], None], order: list[str] | None = None,
                  **options: object) -> Callable[[DataFrame, int], None]:
    """A micro-batch handler: send JSON objects to a search index, keep what it refuses.

    ``identity`` is computed from the column ``value``. The member ``eventType`` becomes the
    index name. Of several documents with one id in a batch, the last one is sent by the
    columns ``order``, such as a topic's partition and offset; without them, the greatest text.
    """

    def handle(lines: DataFrame, batch_id: int) -> None:
        objects = parsing.parse_dynamic_json(lines).kept
        place = F.struct(*order) if order else F.col("value")
        docs = documents.documents(objects.withColumn("place", place), identity, F.col("value"), F.lit(index), keep=("place",),
                                   members=F.col("members"))
        dead_letter(documents.index_documents(documents.last_per_id(docs, "place"), index, connect, **options), batch_id)

    return handle


def rejected_events(lines: DataFrame) -> DataFrame:
    """Lines no event could be read from, for a dead-letter table."""
    return parsing.parse_event_json(lines, missing_int=0).rejected.withColumn("rejected_at", times.load_time())
