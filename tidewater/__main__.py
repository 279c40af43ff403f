"""``python -m tidewater JOB --application.properties FILE --checkpoint DIR [--key value ...]``

Runs one of the streaming jobs on message topics, watched folders or a text socket:

``page_views``    topics matching ``--topics``, results to topic ``--to`` and the console
``user_counts``   topic ``topic_name`` of the properties, results to topic ``--to``; sums and unreadable lines in ``--out``
``join_logs``     topics ``--browse`` and ``--click``, ``--how`` inner, left or right, to files in ``--out``
``group_logs``    the same topics, groups of a window and user when the window has closed, to files in ``--out``
``enrich``        topic ``topic_name`` and the user table of the properties, to files in ``--out``
``host_metrics``  lines of files added to ``--folder``, as messages to topic ``--to``
``word_count``    lines of a socket (``--host``, ``--port``), counts to files in ``--out``
``window_peaks`` / ``window_counts``  ``event,pv`` lines of a socket, to a latest-value table in ``--out``
``count_words``   words of the lines there are in ``--folder``, counted once to files in ``--out``
``count_words_sql``  the same by SQL

Jobs that write files or send messages also print the first rows of each micro-batch.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from tidewater import schemas
from tidewater.plans import jobs
from tidewater.session import build_session, read_arguments, read_properties, shared_dir
from tidewater.sinks import messages as producers
from tidewater.sinks.tables import LatestTable, append_batch
from tidewater.sources import jdbc
from tidewater.sources import messages as topics
from tidewater.sources.rows import SOCKET_HOST, SOCKET_PORT, socket_lines, text_lines, watch_lines
from tidewater.streaming import queries
from tidewater.streaming.dimension import Snapshot, enrich_batches

INTERVAL = "10 seconds"


def _topic(spark: SparkSession, properties: dict[str, str], topic: str | None = None, pattern: str | None = None) -> DataFrame:
    options = topics.consumer_options(
        properties["bootstrap.servers"], topic=topic, pattern=pattern,
        reset=properties.get("auto.offset.reset", "latest"), group_prefix=properties.get("group.id"))
    return topics.message_values(spark, options)


def _socket(spark: SparkSession, args: dict[str, str]) -> DataFrame:
    return socket_lines(spark, args.get("host", SOCKET_HOST), int(args.get("port", SOCKET_PORT)))


def _show_and_send(options: dict[str, str]):
    """Both sinks of one micro-batch, computed once."""

    def handle(rows: DataFrame, batch_id: int) -> None:
        _shown(rows, lambda: producers.send_batch(rows, options))

    return handle


def _shown(rows: DataFrame, write) -> None:
    rows.persist()
    try:
        write()
        rows.show(truncate=False)
    finally:
        rows.unpersist()


def show_and_write(path: str):
    """Every row of a micro-batch to files, the first ones to the console."""
    append = append_batch(path)

    def handle(rows: DataFrame, batch_id: int) -> None:
        _shown(rows, lambda: append(rows, batch_id))

    return handle


#: Jobs that read the files there are and end.
BATCH_JOBS = {"count_words": jobs.word_count, "count_words_sql": jobs.word_count_sql}


def run_once(spark: SparkSession, job: str, args: dict[str, str]) -> None:
    counted = BATCH_JOBS[job](text_lines(spark, args["folder"]))
    counted.write.csv(args["out"])
    spark.read.schema(counted.schema).csv(args["out"]).show(truncate=False)


def start(spark: SparkSession, job: str, args: dict[str, str], properties: dict[str, str]):
    """Start a job; the returned query runs until it is stopped."""
    place = {"checkpoint": args["checkpoint"], "every": args.get("interval", INTERVAL), "name": job}

    def producer() -> dict[str, str]:
        return producers.producer_options(properties["bootstrap.servers"], args["to"])

    if job == "page_views":
        width = f"{properties.get('tumblingWindowLength', '20')} seconds"
        delay = f"{properties.get('outOfOrdernessSeconds', '3')} seconds"
        views = jobs.page_views(_topic(spark, properties, pattern=args["topics"]), width, delay)
        return queries.to_batches(views.selectExpr("line AS value"), _show_and_send(producer()), **place)
    if job == "user_counts":
        lines, to = topics.message_rows(spark, topics.options_from_properties(properties)), producer()
        handle = jobs.user_counts_batches(
            f"{args['out']}/totals", topics.PLACE, lambda rows, _: producers.send_batch(rows, to),
            append_batch(f"{args['out']}/rejected"))
        return queries.to_batches(lines, handle, **place)
    if job == "join_logs":
        sides = [_topic(spark, properties, topic=args[side]) for side in ("browse", "click")]
        return queries.to_batches(jobs.join_logs(*sides, args.get("how", "inner")), show_and_write(args["out"]), **place)
    if job == "group_logs":
        sides = [_topic(spark, properties, topic=args[side]) for side in ("browse", "click")]
        return queries.to_batches(jobs.delivered_logs(*sides), show_and_write(args["out"]), **place)
    if job == "enrich":
        lines = topics.message_values(spark, topics.options_from_properties(properties))
        read = jdbc.reader(spark, jdbc.options_from_properties(properties))
        snapshot = Snapshot(spark, read, schemas.USER_INFO, f"{shared_dir(spark)}/tidewater/user_info")
        handle = enrich_batches(snapshot, "userID", append_batch(args["out"]))
        return queries.to_batches(jobs.events_to_enrich(lines), handle, **place)
    if job == "host_metrics":
        place["every"] = args.get("interval", queries.DIRECTORY_SCAN)
        sent = jobs.host_messages(watch_lines(spark, args["folder"]), args.get("form", "text"))
        return producers.send_stream(sent, producer(), **place)
    if job == "word_count":
        return queries.to_batches(jobs.window_word_count(_socket(spark, args)), show_and_write(args["out"]), **place)
    if job in ("window_peaks", "window_counts"):
        newest = LatestTable(args["out"], ["event"], ["window_end"])
        return queries.to_batches(getattr(jobs, job)(_socket(spark, args)), newest.write_batch, **place)
    raise ValueError(f"unknown job {job!r}")


def main(argv: list[str]) -> None:
    if not argv or argv[0].startswith("-"):
        raise SystemExit(__doc__)
    args = read_arguments(argv[1:])
    spark = build_session(argv[0])
    if argv[0] in BATCH_JOBS:
        run_once(spark, argv[0], args)
        return
    properties: dict[str, str] = {}
    if "application.properties" in args:
        whole = spark.read.text(args["application.properties"], wholetext=True)
        properties = read_properties(whole.first()[0])
    start(spark, argv[0], args, properties).awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
