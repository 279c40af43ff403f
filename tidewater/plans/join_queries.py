"""Co-groups and joins of the browse and click logs, and enrichment by the user table.

Event times are cut to the hour here: the test events are minutes apart, so equal
seconds would hardly ever meet.
"""

from pyspark.sql import functions as F

from tidewater.functions.times import event_time_text
from tidewater.operators import history, joins
from tidewater.plans.catalogue import query
from tidewater.plans.inputs import numbered_events, table

SIDES = """
    WITH logs AS (
        SELECT event_id, user_id, event_type, (props->>'k')::BIGINT AS k, date_trunc('hour', ts) AS hour,
               strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS event_time FROM events),
    browse AS (SELECT * FROM logs WHERE event_type = 'view'),
    click AS (SELECT * FROM logs WHERE event_type = 'click')
"""

KEYS = ["userID", "eventTime"]
WIDTH = "10 seconds"


def _logs(spark, sf_dir):
    logs = numbered_events(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts"))
    common = ["event_id", F.concat(F.lit("user_"), "user_id").alias("userID"),
              event_time_text(F.col("hour")).alias("eventTime"), F.col("event_type").alias("eventType"), "hour"]
    browse = logs.where("event_type = 'view'").select(
        *common, F.concat(F.lit("product_"), "k").alias("productID"), F.col("k").cast("int").alias("productPrice"))
    click = logs.where("event_type = 'click'").select(*common, F.concat(F.lit("page_"), "k").alias("pageID"))
    return browse, click


def _joined(spark, sf_dir, how):
    browse, click = _logs(spark, sf_dir)
    return joins.window_join(browse, click, how, "hour", WIDTH, KEYS)


def _ids(spark, sf_dir, how):
    return _joined(spark, sf_dir, how).select(
        "left_event_id", "right_event_id",
        F.coalesce("left_userID", "right_userID").alias("user"),
        F.coalesce("left_eventTime", "right_eventTime").alias("event_time"))


def join_oracle(how: str) -> str:
    return SIDES + f"""
        SELECT b.event_id AS left_event_id, c.event_id AS right_event_id,
               'user_' || coalesce(b.user_id, c.user_id) AS "user", coalesce(b.event_time, c.event_time) AS event_time
        FROM browse b {how} JOIN click c ON b.user_id = c.user_id AND b.event_time = c.event_time
    """


@query(join_oracle("INNER"))
def join_inner(spark, sf_dir):
    return _ids(spark, sf_dir, "inner")


@query(join_oracle("LEFT"))
def join_left(spark, sf_dir):
    return _ids(spark, sf_dir, "left")


@query(join_oracle("RIGHT"))
def join_right(spark, sf_dir):
    return _ids(spark, sf_dir, "right")


@query(SIDES + """
    SELECT 'UserBrowseLog{userID=''user_' || b.user_id || ''', eventTime=''' || b.event_time || ''', eventType=''view'', productID=''product_'
           || b.k || ''', productPrice=' || b.k || '} ==Left Join=> '
           || CASE WHEN c.event_id IS NULL THEN 'null' ELSE
              'UserClickLog{userID=''user_' || c.user_id || ''', eventTime=''' || c.event_time || ''', eventType=''click'', pageID=''page_'
              || c.k || '''}' END AS line
    FROM browse b LEFT JOIN click c ON b.user_id = c.user_id AND b.event_time = c.event_time
""")
def join_render(spark, sf_dir):
    return joins.render_join(_joined(spark, sf_dir, "left"), "left")


def _members(spark, sf_dir):
    browse, click = _logs(spark, sf_dir)
    return joins.cogroup_rows(browse, click, "hour", WIDTH, KEYS, F.col("event_id"), F.col("event_id"))


@query(SIDES + """
    SELECT 'user_' || user_id AS "user", event_time, event_time AS window_start,
           strftime(hour + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS window_end,
           CASE WHEN event_type = 'view' THEN 'left' ELSE 'right' END AS side, event_id
    FROM logs WHERE event_type IN ('view', 'click')
""")
def cogroup_rows(spark, sf_dir):
    return _members(spark, sf_dir).select(
        F.col("userID").alias("user"), F.col("eventTime").alias("event_time"),
        event_time_text(F.col("window.start")).alias("window_start"),
        event_time_text(F.col("window.end")).alias("window_end"),
        "side", F.col("payload").alias("event_id"))


@query(SIDES + """
    SELECT 'user_' || user_id AS "user", event_time,
           count(*) FILTER (event_type = 'view') AS n_left, count(*) FILTER (event_type = 'click') AS n_right,
           min(event_id) FILTER (event_type = 'view') AS first_left, max(event_id) FILTER (event_type = 'view') AS last_left,
           min(event_id) FILTER (event_type = 'click') AS first_right, max(event_id) FILTER (event_type = 'click') AS last_right
    FROM logs WHERE event_type IN ('view', 'click') GROUP BY 1, 2
""")
def cogroup_window(spark, sf_dir):
    groups = joins.cogroup_summary(_members(spark, sf_dir), KEYS)
    return groups.withColumnsRenamed({"userID": "user", "eventTime": "event_time"}).drop("window")


@query("""
    SELECT e.event_id, e.user_id * 11 AS user_id, strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS event_time, e.event_type,
           (e.props->>'k')::BIGINT AS product_id, c.c_name AS user_name, c.c_nationkey AS user_age
    FROM events e JOIN customer c ON c.c_custkey = e.user_id * 11
""")
def enrich_broadcast(spark, sf_dir):
    """User numbers are spread, so that some have no entry."""
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"), F.col("c_nationkey").alias("user_age"))
    events = numbered_events(spark, sf_dir).withColumn("user_id", F.col("user_id") * 11)
    found = joins.enrich(events, people, "user_id")
    return found.select("event_id", "user_id", event_time_text(F.col("ts")).alias("event_time"), "event_type",
                        F.col("k").alias("product_id"), "user_name", "user_age")


@query("""
    WITH change AS (SELECT date_trunc('second', min(ts) + (max(ts) - min(ts)) / 2) AS at FROM events)
    SELECT e.event_id, e.user_id * 11 AS user_id,
           CASE WHEN e.ts >= change.at AND c_custkey % 5 = 0 THEN c.c_name || ' (moved)' ELSE c.c_name END AS user_name
    FROM events e JOIN customer c ON c.c_custkey = e.user_id * 11, change
    WHERE (e.ts < change.at AND c_custkey % 4 <> 1) OR (e.ts >= change.at AND c_custkey % 3 <> 0)
""")
def enrich_as_of(spark, sf_dir):
    """Two reads of the user table: in between some users are added, some deleted and some renamed."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", (F.col("user_id") * 11).alias("user_id"))
    bounds = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    change = bounds.select(F.date_trunc("second", F.col("a") + (F.col("b") - F.col("a")) / 2)).scalar()
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"))
    moved = F.when(F.col("user_id") % 5 == 0, F.concat("user_name", F.lit(" (moved)"))).otherwise(F.col("user_name"))
    first = users.where("user_id % 4 <> 1").withColumn(history.FROM, F.lit("1970-01-01 00:00:00").cast("timestamp"))
    second = users.where("user_id % 3 <> 0").withColumn("user_name", moved).withColumn(history.FROM, change.cast("timestamp"))
    past = history.intervals(first.union(second), ["user_id"])
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return history.enrich_as_of(timed, past, ["user_id"], "ts").drop("ts")
