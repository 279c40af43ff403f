"""The streaming forms, run over the driver's tables as streams of files.

Each query starts a stream, lets it read what is there, waits for its end and returns
what the sink holds. Inputs with windows are ended, so that open windows and rows without a match come out too.
Counts come without event ids: the order of arrival says which event got which count.
"""

import uuid

from pyspark.sql import functions as F

from tidewater.functions.times import event_time_text
from tidewater.operators import joins, latest, routing, windows
from tidewater.plans.catalogue import QUERIES, query
from tidewater.plans.inputs import ORDER, table
from tidewater.plans.join_queries import KEYS, SIDES, WIDTH, join_oracle
from tidewater.plans.running_queries import _HOURLY
from tidewater.plans.window_queries import pv_oracle
from tidewater.session import shared_dir, use_rocksdb
from tidewater.sinks import tables as sinks
from tidewater.sinks import two_phase
from tidewater.sources.rows import watch_table
from tidewater.streaming import carried, cogroups, expiry, processors, rescaling
from tidewater.streaming.dimension import Snapshot, enrich_batches
from tidewater.streaming.ending import Ending
from tidewater.streaming.queries import finish, state_partitions, to_batches, to_files

DELAY = "3 seconds"
# Parts of a query's state unless the session sets another number; fixed for the life of a checkpoint.
STATE_STORES = "16"
# Parts the keys of a query with many keys are dealt to: at 6 GB of tables some seventy thousand rows and a thousand users each.
KEY_PARTS = 512


def _place(spark):
    """A new folder for one run's output and checkpoint."""
    use_rocksdb(spark)
    return f"{shared_dir(spark)}/tidewater/{uuid.uuid4().hex}"


def _events(spark, sf_dir):
    # A pattern, as a file stream takes a folder or a pattern but not the name of one file.
    events = watch_table(spark, f"{sf_dir}/[e]vents.parquet")
    number = F.get_json_object("props", "$.k").cast("bigint")
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", number.alias("k"))


def _run(spark, start, ending=None):
    """Run a stream to its end; ``spark.tidewater.stateStores`` says in how many parts it keeps its state."""
    with state_partitions(spark, int(spark.conf.get("spark.tidewater.stateStores", STATE_STORES))):
        if ending is None:
            finish(start())
        else:
            ending.run(start)


def _files(spark, stream, ending=None, **options):
    """Run a stream into files and read them back."""
    place = _place(spark)
    _run(spark, lambda: to_files(stream, f"{place}/out", f"{place}/checkpoint", **options), ending)
    return spark.read.schema(stream.schema).parquet(f"{place}/out")


def _ending(spark):
    return Ending(spark, f"{_place(spark)}/end")


@query(pv_oracle("1 HOUR"))
def stream_pv_tumbling(spark, sf_dir):
    ending = _ending(spark)
    timed = ending.timed(_events(spark, sf_dir), "ts", DELAY)
    return _files(spark, windows.page_views(timed, "ts", "1 hour", "event_type"), ending)


@query(_HOURLY + """
    SELECT event_type, arg_max(window_start, window_end) AS window_start, max(window_end) AS window_end,
           arg_max("count", window_end) AS "count", arg_max("sum", window_end) AS "sum" FROM hourly GROUP BY 1
""")
def stream_latest_window_count_sum(spark, sf_dir):
    """Published window state: closed windows go to a latest-value table."""
    ending = _ending(spark)
    timed = ending.timed(_events(spark, sf_dir), "ts", DELAY)
    hourly = windows.window_count_sum(timed, "ts", "1 hour", "event_type", F.col("k"))
    place = _place(spark)
    newest = sinks.LatestTable(f"{place}/latest", ["event_type"], ["window_end"])
    _run(spark, lambda: to_batches(hourly, newest.write_batch, f"{place}/checkpoint"), ending)
    return newest.read(spark)


@query(_HOURLY + """
    SELECT event_type, max(window_end) AS window_end, arg_max(max_value, window_end) AS max_value
    FROM hourly WHERE event_type IN ('view', 'click') GROUP BY 1
""")
def stream_state_lookup(spark, sf_dir):
    ending = _ending(spark)
    timed = ending.timed(_events(spark, sf_dir), "ts", DELAY)
    hourly = windows.window_max(timed, "ts", "1 hour", "event_type", F.col("k"))
    place = _place(spark)
    newest = sinks.LatestTable(f"{place}/latest", ["event_type"], ["window_end"])
    _run(spark, lambda: to_batches(hourly, newest.write_batch, f"{place}/checkpoint"), ending)
    found = latest.look_up(newest.read(spark), "event_type", ["view", "click", "absent"])
    return found.select("event_type", "window_end", "max_value")


def _stream_sides(spark, sf_dir, ending):
    logs = _events(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts"))
    logs = logs.select("event_id", F.concat(F.lit("user_"), "user_id").alias("userID"),
                       event_time_text(F.col("hour")).alias("eventTime"), "hour", "event_type")
    return [ending.timed(logs.where(F.col("event_type") == side).drop("event_type"), "hour", "0 seconds")
            for side in ("view", "click")]


def _stream_join(spark, sf_dir, how):
    ending = _ending(spark)
    joined = joins.window_join(*_stream_sides(spark, sf_dir, ending), how, "hour", WIDTH, KEYS)
    return _files(spark, joined.select(
        "left_event_id", "right_event_id", F.coalesce("left_userID", "right_userID").alias("user"),
        F.coalesce("left_eventTime", "right_eventTime").alias("event_time")), ending)


@query(join_oracle("INNER"))
def stream_join_inner(spark, sf_dir):
    return _stream_join(spark, sf_dir, "inner")


@query(join_oracle("LEFT"))
def stream_join_left(spark, sf_dir):
    return _stream_join(spark, sf_dir, "left")


@query(join_oracle("RIGHT"))
def stream_join_right(spark, sf_dir):
    return _stream_join(spark, sf_dir, "right")


@query(SIDES + """
    SELECT 'user_' || user_id AS "user", event_time, event_time AS window_start,
           strftime(hour + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS window_end,
           CASE WHEN event_type = 'view' THEN 'left' ELSE 'right' END AS side, event_id,
           count(*) FILTER (event_type = 'view') OVER (PARTITION BY user_id, hour) AS n_left,
           count(*) FILTER (event_type = 'click') OVER (PARTITION BY user_id, hour) AS n_right
    FROM logs WHERE event_type IN ('view', 'click')
""")
def stream_cogroup(spark, sf_dir):
    """Groups delivered once their windows have closed."""
    ending = _ending(spark)
    members = joins.cogroup_rows(*_stream_sides(spark, sf_dir, ending), "hour", WIDTH, KEYS, F.col("event_id"), F.col("event_id"))
    groups = _files(spark, cogroups.delivered_groups(members, KEYS), ending)
    return groups.select(
        F.col("userID").alias("user"), F.col("eventTime").alias("event_time"),
        event_time_text(F.col("window_start")).alias("window_start"), event_time_text(F.col("window_end")).alias("window_end"),
        "side", F.col("payload").alias("event_id"), "n_left", "n_right")


@query(join_oracle("LEFT"))
def stream_join_salted(spark, sf_dir):
    """The users with more than a hundredth of all views are salted."""
    ending = _ending(spark)
    sides = _stream_sides(spark, sf_dir, ending)
    views = table(spark, sf_dir, "events").where("event_type = 'view'")
    users = joins.hot_keys(views.select(F.concat(F.lit("user_"), "user_id").alias("userID")), ["userID"])
    hot = F.col("userID").isin([user for (user,) in users])
    joined = joins.window_join(*sides, "left", "hour", WIDTH, KEYS, salts=8, hot=hot)
    return _files(spark, joined.select(
        "left_event_id", "right_event_id", F.coalesce("left_userID", "right_userID").alias("user"),
        F.coalesce("left_eventTime", "right_eventTime").alias("event_time")), ending)


def _carried(spark, sf_dir, batches, keys):
    """Micro-batches through the sliced operators: a hot key is spread over tasks."""
    place = _place(spark)
    handle = batches(f"{place}/totals", keys, ORDER, sinks.append_batch(f"{place}/out"))
    events = _events(spark, sf_dir).select(*dict.fromkeys([*ORDER, "user_id", *keys]))
    _run(spark, lambda: to_batches(events, handle, f"{place}/checkpoint"))
    return sinks.read_batches(spark, f"{place}/out")


@query("""
    SELECT user_id, 'user_' || user_id || ' : ' || row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS line
    FROM events
""")
def stream_running_count_by_user(spark, sf_dir):
    counted = _carried(spark, sf_dir, carried.running_count_batches, ["user_id"])
    return counted.select("user_id", F.concat_ws(" : ", F.concat(F.lit("user_"), "user_id"), "n").alias("line"))


@query("""
    SELECT event_id, user_id, sum((props->>'k')::BIGINT) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS total
    FROM events
""")
def stream_running_sum_by_user(spark, sf_dir):
    """Micro-batches in event order, so the events keep their ids."""
    place = _place(spark)
    handle = carried.running_sum_batches(f"{place}/totals", ["user_id"], ORDER, "k", sinks.append_batch(f"{place}/out"))
    events = _events(spark, sf_dir).select(*ORDER, "user_id", "k")
    _run(spark, lambda: to_batches(events, handle, f"{place}/checkpoint"))
    return sinks.read_batches(spark, f"{place}/out").select("event_id", "user_id", "total")


@query("""
    WITH numbered AS (
        SELECT user_id, (props->>'k')::BIGINT AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n
        FROM events)
    SELECT user_id, (sum(k) // count(*))::BIGINT AS average FROM numbered GROUP BY user_id, n // 2 HAVING count(*) = 2
""")
def stream_pair_average(spark, sf_dir):
    place = _place(spark)
    handle = carried.pair_average_batches(f"{place}/open", ["user_id"], ORDER, "k", sinks.append_batch(f"{place}/out"))
    events = _events(spark, sf_dir).select(*ORDER, "user_id", "k")
    _run(spark, lambda: to_batches(events, handle, f"{place}/checkpoint"))
    return sinks.read_batches(spark, f"{place}/out").drop(sinks.BATCH)


@query("""
    SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events
""")
def stream_behavior_count(spark, sf_dir):
    return _carried(spark, sf_dir, carried.running_count_batches, ["user_id", "event_type"]).select("user_id", "event_type", "n")


@query("""
    WITH counted AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
    SELECT user_id, true AS is_add, n FROM counted
    UNION ALL SELECT user_id, false AS is_add, n - 1 AS n FROM counted WHERE n > 1
""")
def stream_retract_running_count(spark, sf_dir):
    return _carried(spark, sf_dir, carried.count_changes_batches, ["user_id"]).select("user_id", "is_add", "n")


@query("SELECT count(*)::BIGINT AS n FROM events WHERE event_type = 'purchase'")
def stream_buy_total(spark, sf_dir):
    buys = _events(spark, sf_dir).where("event_type = 'purchase'")
    parts = processors.sharded_count(buys, "event_id", shards=16)
    place = _place(spark)
    newest = sinks.LatestTable(f"{place}/latest", ["shard"], ["n"])
    _run(spark, lambda: to_batches(parts, newest.write_batch, f"{place}/checkpoint", mode="update"))
    return processors.shard_total(newest.read(spark))


@query("""
    SELECT e.event_id, e.user_id * 11 AS user_id, e.event_type, c.c_name AS user_name, c.c_nationkey AS user_age
    FROM events e JOIN customer c ON c.c_custkey = e.user_id * 11
""")
def stream_enrich(spark, sf_dir):
    def people():
        return table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"),
            F.col("c_nationkey").alias("user_age"))

    place = _place(spark)
    snapshot = Snapshot(spark, people, people().schema, f"{place}/dimension")
    events = _events(spark, sf_dir).select("event_id", (F.col("user_id") * 11).alias("user_id"), "event_type")
    handle = enrich_batches(snapshot, "user_id", sinks.append_batch(f"{place}/out"))
    _run(spark, lambda: to_batches(events, handle, f"{place}/checkpoint"))
    return sinks.read_batches(spark, f"{place}/out").drop(sinks.BATCH)


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click'")
def stream_split_select(spark, sf_dir):
    """All outputs in one pass: each goes to its own folder of one exactly-once sink."""
    rows = _events(spark, sf_dir).select("event_id", "user_id", "event_type")
    tagged = routing.tag(rows, {"clicks": F.col("event_type") == "click", "buys": F.col("event_type") == "purchase"})
    routed = tagged.select("event_id", "user_id", "event_type", F.explode(routing.OUTPUTS).alias("output"))
    return _files(spark, routed, partition_by=["output"]).where("output = 'clicks'").drop("output")


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click'")
def stream_delivered_once(spark, sf_dir):
    """Staged by tasks, committed by batch."""
    place = _place(spark)
    clicks = _events(spark, sf_dir).where("event_type = 'click'").select("event_id", "user_id", "event_type")
    _run(spark, lambda: two_phase.deliver(clicks, f"{place}/out", f"{place}/checkpoint"))
    return two_phase.delivered(spark, f"{place}/out", clicks.schema)


@query("SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events")
def stream_rescaled_count(spark, sf_dir):
    """Counts of the events of one kind go on, with all others, in a query that has half as many stores."""
    ones = _events(spark, sf_dir).select("user_id", "event_type", F.lit(1).alias("one"))
    place, stores = _place(spark), int(spark.conf.get("spark.tidewater.stateStores", STATE_STORES))
    views, others = (ones.where(c).drop("event_type") for c in ("event_type = 'view'", "event_type <> 'view'"))

    def run(stream, number, folder, initial=None):
        counted = processors.running_sum(stream, ["user_id"], "one", "n", initial, KEY_PARTS).select("user_id", "n")
        with state_partitions(spark, number):
            finish(to_files(counted, f"{place}/{folder}/out", f"{place}/{folder}/checkpoint"))
        return spark.read.schema(counted.schema).parquet(f"{place}/{folder}/out")

    before = run(views, stores, "before")
    kept = rescaling.kept_state(spark, f"{place}/before/checkpoint", "total")
    return before.union(run(others, max(1, stores // 2), "after", kept))


@query(QUERIES["behavior_count_ttl"].oracle)
def stream_behavior_count_ttl(spark, sf_dir):
    """Counts in event order that expire by timers."""
    ending = _ending(spark)
    timed = ending.timed(_events(spark, sf_dir), "ts", DELAY)
    counted = expiry.count_with_expiry(timed, ["user_id", "event_type"], "ts", "event_id", 24 * 3600, parts=KEY_PARTS)
    return _files(spark, counted, ending).select("event_id", "user_id", "event_type", "n")
