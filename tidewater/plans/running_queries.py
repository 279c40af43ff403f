"""Row-order queries: running counts and sums, pairs, expiry, changes, ranks."""

import uuid

from pyspark.sql import functions as F

from tidewater.operators import changelog, latest, running
from tidewater.operators.tables import equal_to
from tidewater.operators.windows import window_count_sum, window_max
from tidewater.plans.catalogue import query
from tidewater.plans.inputs import ORDER, numbered_events, table
from tidewater.session import shared_dir
from tidewater.sinks.lookups import LookupTable


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(*ORDER, "user_id", "event_type")


@query("""
    SELECT event_id, 'user_' || user_id || ' : ' || count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS line
    FROM events
""")
def running_count_by_user(spark, sf_dir):
    ones = _events(spark, sf_dir).select(*ORDER, F.concat(F.lit("user_"), "user_id").alias("userID"), F.lit(1).alias("one"))
    counted = running.running_sum(ones, ["userID"], ORDER, "one")
    return counted.select("event_id", F.concat_ws(" : ", "userID", "total").alias("line"))


@query("""
    SELECT event_id, user_id, sum((props->>'k')::BIGINT) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS total
    FROM events
""")
def running_sum_by_user(spark, sf_dir):
    events = numbered_events(spark, sf_dir).drop("event_type")
    return running.running_sum(events, ["user_id"], ORDER, "k").select("event_id", "user_id", "total")


_PAIRS = """
    WITH numbered AS (
        SELECT event_id, user_id, (props->>'k')::BIGINT AS k,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events)
"""


@query(_PAIRS + """
    SELECT user_id, n // 2 AS pair_no, (sum(k) // count(*))::BIGINT AS average
    FROM numbered GROUP BY user_id, n // 2 HAVING count(*) = 2
""")
def pair_average(spark, sf_dir):
    return running.pair_average(numbered_events(spark, sf_dir), ["user_id"], ORDER, "k")


@query(_PAIRS + """
    , paired AS (SELECT *, lag(k) OVER (PARTITION BY user_id ORDER BY n) AS k0 FROM numbered)
    SELECT event_id, CASE WHEN n % 2 = 1 THEN user_id ELSE 0 END AS user_id,
           (CASE WHEN n % 2 = 1 THEN (k + k0) // 2 ELSE 0 END)::BIGINT AS average
    FROM paired
""")
def pair_average_padded(spark, sf_dir):
    return running.pair_average_padded(numbered_events(spark, sf_dir), "user_id", ORDER, "k")


@query("""
    SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n
    FROM events
""")
def behavior_running_count(spark, sf_dir):
    counted = running.running_count(_events(spark, sf_dir), ["user_id", "event_type"], ORDER)
    return counted.select("event_id", "user_id", "event_type", "n")


@query("""
    WITH gaps AS (
        SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS previous FROM events),
    runs AS (
        SELECT *, sum(CASE WHEN previous IS NULL OR ts >= previous + INTERVAL 1 DAY THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS run FROM gaps)
    SELECT event_id, user_id, event_type,
           row_number() OVER (PARTITION BY user_id, event_type, run ORDER BY ts, event_id) AS n
    FROM runs
""")
def behavior_count_ttl(spark, sf_dir):
    counted = running.running_count_with_expiry(
        _events(spark, sf_dir), ["user_id", "event_type"], ORDER, time="ts", ttl="1 day")
    return counted.select("event_id", "user_id", "event_type", "n")


@query("""
    SELECT event_id, 'buy' AS behavior, row_number() OVER (ORDER BY ts, event_id) AS n
    FROM events WHERE event_type = 'purchase'
""")
def buy_running_count(spark, sf_dir):
    buys = equal_to(_events(spark, sf_dir), "event_type", "purchase").select(*ORDER)
    counted = running.running_count(buys, [], ORDER)
    return counted.select("event_id", F.lit("buy").alias("behavior"), "n")


@query("""
    SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS user_count,
           row_number() OVER (ORDER BY ts, event_id) AS total_count
    FROM events WHERE event_type = 'purchase'
""")
def buy_user_and_total(spark, sf_dir):
    buys = equal_to(_events(spark, sf_dir), "event_type", "purchase").select(*ORDER, "user_id")
    per_user = running.running_count(buys, ["user_id"], ORDER, "user_count")
    return running.running_count(per_user, [], ORDER, "total_count", same_rows=buys).select(
        "event_id", "user_id", "user_count", "total_count")


@query("SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_size, p_partkey) AS position FROM part")
def sort_by_attribute(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return running.sorted_with_rank(parts, ["p_size", "p_partkey"])


@query("""
    SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back FROM events)
    WHERE back = 1
""")
def upsert_last_by_id(spark, sf_dir):
    newest = latest.latest(_events(spark, sf_dir), ["user_id"], ORDER)
    shown = F.substring(F.col("ts").cast("string"), 1, 19)
    return newest.select("user_id", "event_id", shown.alias("event_time"), "event_type")


_HOURLY = """
    WITH hourly AS (
        SELECT event_type, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
               max((props->>'k')::BIGINT) AS max_value, count(*)::BIGINT AS "count", sum((props->>'k')::BIGINT)::BIGINT AS "sum"
        FROM events GROUP BY ALL)
"""


def _latest_max(spark, sf_dir):
    hourly = window_max(numbered_events(spark, sf_dir), "ts", "1 hour", "event_type", F.col("k"))
    return latest.latest(hourly, ["event_type"], ["window_end"])


@query(_HOURLY + """
    SELECT event_type, arg_max(window_start, window_end) AS window_start, max(window_end) AS window_end,
           arg_max(max_value, window_end) AS max_value FROM hourly GROUP BY 1
""")
def latest_window_max(spark, sf_dir):
    return _latest_max(spark, sf_dir)


@query(_HOURLY + """
    SELECT event_type, arg_max(window_start, window_end) AS window_start, max(window_end) AS window_end,
           arg_max("count", window_end) AS "count", arg_max("sum", window_end) AS "sum" FROM hourly GROUP BY 1
""")
def latest_window_count_sum(spark, sf_dir):
    hourly = window_count_sum(numbered_events(spark, sf_dir), "ts", "1 hour", "event_type", F.col("k"))
    return latest.latest(hourly, ["event_type"], ["window_end"])


@query(_HOURLY + """
    SELECT event_type, max(window_end) AS window_end, arg_max(max_value, window_end) AS max_value
    FROM hourly WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1
""")
def state_lookup(spark, sf_dir):
    found = latest.look_up(_latest_max(spark, sf_dir), "event_type", ["view", "click", "purchase", "absent"])
    return found.select("event_type", "window_end", "max_value")


@query("""
    SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type
    FROM events WHERE user_id IN (SELECT c_custkey FROM customer) GROUP BY 1
""")
def lookup_by_bucket(spark, sf_dir):
    """Every user's newest event, written in batches; of the customers only, whose buckets alone are opened."""
    events = numbered_events(spark, sf_dir).select("user_id", *ORDER, "event_type")
    newest = LookupTable(spark, f"{shared_dir(spark)}/tidewater/{uuid.uuid4().hex}", ["user_id"], ORDER, buckets=16)
    for number, part in enumerate(("event_type = 'view'", "event_type = 'click'", "event_type NOT IN ('view', 'click')")):
        newest.write_batch(events.where(part), number)
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("user_id"))
    return newest.look_up_rows(customers).select("user_id", *ORDER, "event_type")


@query("SELECT true AS is_add, c_name AS name, c_nationkey AS age FROM customer")
def retract_insert_only(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("age"))
    return changelog.append_only(people)


@query("""
    WITH counted AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
    SELECT user_id, true AS is_add, n FROM counted
    UNION ALL SELECT user_id, false AS is_add, n - 1 AS n FROM counted WHERE n > 1
""")
def retract_running_count(spark, sf_dir):
    return changelog.count_changes(_events(spark, sf_dir), ["user_id"], ORDER)
