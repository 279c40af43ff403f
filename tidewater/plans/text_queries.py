"""Filters, projections, parsers, scalar functions and word counts."""

from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions import display, hashing, json, text, times
from tidewater.operators import parsing, tables
from tidewater.plans.catalogue import query
from tidewater.plans.inputs import event_records, numbered_events, table


@query("""
    SELECT w AS word, count(*)::BIGINT AS frequency
    FROM (SELECT unnest(string_split(text, ',')) AS w FROM documents)
    WHERE length(w) > 0 GROUP BY 1
""")
def word_count(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return tables.count_words(documents, text.split_on(F.col("text"), ","))


@query(r"""
    SELECT w AS word, count(*)::BIGINT AS frequency
    FROM (SELECT unnest(string_split(regexp_replace(line, ',+\z', ''), ',')) AS w
          FROM (SELECT CASE WHEN doc_id % 5 = 0 THEN repeat(',', (doc_id % 3)::INTEGER)
                       ELSE ',' || replace(text, '. ', ',,') || ',,' END AS line FROM documents)
          WHERE length(line) > 0 AND NOT regexp_full_match(line, ',+'))
    GROUP BY 1
""")
def tokenize_keep_empty(spark, sf_dir):
    """Lines that start, go on and end with empty elements, or have nothing else."""
    made = table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 5 == 0, F.repeat(F.lit(","), (F.col("doc_id") % 3).cast("int"))).otherwise(
            F.concat(F.lit(","), F.replace("text", F.lit(". "), F.lit(",,")), F.lit(",,"))).alias("text"))
    lines = tables.non_empty(made, "text")
    return tables.count_words(lines, text.split_on(F.col("text"), ","), keep_empty=True)


@query(r"""
    SELECT w AS word, count(*)::BIGINT AS frequency
    FROM (SELECT unnest(string_split_regex(regexp_replace(event_type || ' ' || props, '\W+\z', ''), '\W+')) AS w
          FROM events)
    GROUP BY 1
""")
def sql_word_count(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select(F.concat_ws(" ", "event_type", "props").alias("line"))
    pieces = tables.words(lines, text.split_pattern(F.col("line"), "\\W+"), keep_empty=True)
    tables.register(pieces.withColumn("n", F.lit(1)), "WordCount", "word,frequency")
    counted = spark.sql("SELECT word AS word, sum(frequency) AS frequency FROM WordCount GROUP BY word")
    return tables.as_records(counted, schemas.WORD_COUNT)


@query("SELECT conv_id, turn, role FROM conversations WHERE turn % 3 <> 0 AND turn % 4 <> 0 AND length(text) > 0")
def filter_non_empty(spark, sf_dir):
    """Every third turn is made empty, every fourth null."""
    turns = table(spark, sf_dir, "conversations").withColumn("text", F.when(F.col("turn") % 3 == 0, "").when(
        F.col("turn") % 4 != 0, F.col("text")))
    return tables.non_empty(turns, "text").select("conv_id", "turn", "role")


@query("SELECT event_id, user_id FROM events WHERE event_type = 'purchase'")
def filter_equals(spark, sf_dir):
    return tables.equal_to(table(spark, sf_dir, "events"), "event_type", "purchase").select("event_id", "user_id")


@query("""
    SELECT event_type AS f0, (props->>'k')::BIGINT AS f1 FROM events
    WHERE (props->>'k')::BIGINT > 10 AND event_type = 'view'
""")
def table_select_where(spark, sf_dir):
    pairs = numbered_events(spark, sf_dir).select("event_type", "k")
    return tables.named(pairs).select("f0", "f1").where("f1 > 10").where("f0 = 'view'")


@query("SELECT c_name AS name FROM customer")
def sql_projection(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_name", "c_nationkey")
    tables.register(customers, "tidewater_people", "name,age")
    return spark.sql("SELECT name FROM tidewater_people")


@query("SELECT event_id, event_type AS event, (props->>'k')::BIGINT AS pv FROM events WHERE event_type <> 'error'")
def parse_csv_pair(spark, sf_dir):
    """Padded pairs; those of ``error`` events carry no readable number and are rejected."""
    events = numbered_events(spark, sf_dir)
    number = F.when(F.col("event_type") == "error", F.lit("none")).otherwise(F.col("k").cast("string"))
    lines = events.select("event_id", F.concat(F.lit("\t "), "event_type", F.lit(","), number, F.lit(" \r")).alias("value"))
    return parsing.parse_csv_pair(lines, keep=("event_id",)).kept


def _host_lines(spark, sf_dir):
    """Orders written as metrics lines; the last field of ``P`` orders is empty."""
    reserved = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(times.event_time_text(F.col("o_orderdate")))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.join_fields(
        "|", F.col("o_orderpriority"), F.col("o_orderstatus"), F.lit("6.1"), F.col("o_custkey"), F.lit("12.5%"),
        F.lit("7.63GB"), F.lit("40.1%"), F.lit("17"), F.lit("vendor"), F.col("o_orderkey") * 1000, reserved,
    ).alias("value"))


@query("""
    SELECT o_orderkey, 0::BIGINT AS "timeStamp", o_orderpriority AS os_name, NULL::VARCHAR AS os_arch, 0.0::DOUBLE AS os_version,
           o_custkey::INTEGER AS total_cup, '12.5%' AS cup_ratio, '7.63GB' AS total_memory, '40.1%' AS memory_ratio,
           NULL::VARCHAR AS java_version, NULL::VARCHAR AS java_vm_vendo, o_orderkey * 1000 AS "eventTime",
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "reservedTime"
    FROM orders WHERE o_orderstatus <> 'P'
""")
def parse_pipe(spark, sf_dir):
    lines = _host_lines(spark, sf_dir)
    return parsing.parse_host_metrics(lines, load_millis=F.lit(0), keep=("o_orderkey",)).kept


@query("""
    SELECT o_orderkey, o_orderpriority || '|' || o_orderstatus || '|6.1|' || o_custkey || '|12.5%|7.63GB|40.1%|17|vendor|'
           || (o_orderkey * 1000) || '|'
           || CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS value
    FROM orders
""")
def encode_pipe(spark, sf_dir):
    return _host_lines(spark, sf_dir)


def _event_json(spark, sf_dir):
    """Events as JSON text; ``error`` events have an unreadable product, ``signup`` events none."""
    kind = F.col("eventType")
    product = F.when(kind == "error", F.lit('"none"')).otherwise(F.col("productID").cast("string"))
    member = F.when(kind == "signup", F.lit("")).otherwise(F.concat(F.lit(', "productID": '), product))
    return event_records(spark, sf_dir).select("event_id", F.concat(
        F.lit('{"userID": "'), "userID", F.lit('", "eventTime": "'), "eventTime", F.lit('", "eventType": "'), "eventType",
        F.lit('"'), member, F.lit("}")).alias("value"))


@query("""
    SELECT event_id, 'user_' || user_id AS "userID", strftime(ts, '%Y-%m-%d %H:%M:%S') AS "eventTime",
           event_type AS "eventType",
           CASE WHEN event_type = 'signup' THEN 0 ELSE (props->>'k')::INTEGER END AS "productID"
    FROM events WHERE event_type <> 'error'
""")
def json_extract(spark, sf_dir):
    lines = _event_json(spark, sf_dir)
    return parsing.parse_event_json(lines, keep=("event_id",), missing_int=0).kept


@query("SELECT event_id FROM events WHERE event_type = 'error'")
def json_rejected(spark, sf_dir):
    lines = _event_json(spark, sf_dir)
    return parsing.parse_event_json(lines, missing_int=0).rejected.select("event_id")


@query("""
    SELECT event_id, '{"userID":"user_' || user_id || '","eventTime":"' || strftime(ts, '%Y-%m-%d %H:%M:%S')
           || '","eventType":"' || event_type || '","productID":' || (props->>'k') || '}' AS value
    FROM events
""")
def json_encode(spark, sf_dir):
    records = event_records(spark, sf_dir)
    return records.select("event_id", json.to_record("userID", "eventTime", "eventType", "productID").alias("value"))


@query("""
    SELECT event_id, '{"k":' || (props->>'k') || ',"eventType":"product"}' AS value FROM events
""")
def json_put(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", json.json_put(F.col("props"), "eventType", F.lit("product")).alias("value"))


@query("""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_time FROM events
""")
def event_time_parse(spark, sf_dir):
    """Texts of ``error`` events use another format, so they have no timestamp."""
    shown = times.event_time_text(F.col("ts"))
    written = F.when(F.col("event_type") == "error", F.translate(shown, "-", "/")).otherwise(shown)
    events = table(spark, sf_dir, "events").select("event_id", written.alias("written"))
    parsed = times.parse_event_time(F.col("written"))
    return events.select("event_id", times.event_time_text(parsed).alias("event_time"))


@query("""
    SELECT event_id, abs((CASE WHEN h > 2147483647 THEN h - 4294967296 ELSE h END) % 7)::INTEGER AS "partition"
    FROM (SELECT event_id, list_reduce(
            list_transform(string_split(event_type || '_' || user_id, ''), lambda c: ascii(c)::BIGINT),
            lambda a, x: ((a * 31 + x) & 4294967295), 0::BIGINT) AS h FROM events)
""")
def hash_partition(spark, sf_dir):
    key = F.concat_ws("_", "event_type", "user_id")
    return table(spark, sf_dir, "events").select("event_id", hashing.hash_partition(key, 7).alias("partition"))


# Half-even rounding to two decimals in whole numbers, zeros at the end removed.
_SIZE_ORACLE = """
    WITH sized AS (SELECT doc_id, n_chars * 1000 AS size FROM documents),
    scaled AS (SELECT doc_id, CASE WHEN size < 1048576 THEN 'KB' WHEN size < 1073741824 THEN 'MB' ELSE 'GB' END AS unit,
                      CASE WHEN size < 1048576 THEN 1024 WHEN size < 1073741824 THEN 1048576 ELSE 1073741824 END AS step,
                      size FROM sized),
    cut AS (SELECT doc_id, unit, step, (size * 100) // step AS low, (size * 100) % step AS rest FROM scaled),
    rounded AS (SELECT doc_id, unit, low + CASE WHEN rest * 2 > step OR (rest * 2 = step AND low % 2 = 1) THEN 1 ELSE 0 END AS q
                FROM cut)
    SELECT doc_id, (q // 100)
           || CASE WHEN q % 100 = 0 THEN '' ELSE '.' || rtrim(lpad((q % 100)::VARCHAR, 2, '0'), '0') END || unit AS size
    FROM rounded
"""


@query(_SIZE_ORACLE)
def format_bytes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", display.format_bytes(F.col("n_chars") * 1000).alias("size"))


@query("SELECT l_orderkey, l_linenumber, round(l_discount * 100)::INTEGER || '%' AS used FROM lineitem")
def format_ratio(spark, sf_dir):
    hundredths = F.round(F.col("l_discount") * 100).cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", display.used_share(F.lit(100), 100 - hundredths).alias("used"))


@query("""
    WITH cents AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
    shares AS (SELECT o_orderkey, cents % 10000 AS q, cents % 64 * 10000 // 64 AS low, cents % 64 * 10000 % 64 AS rest FROM cents),
    rounded AS (SELECT o_orderkey, q, low + CASE WHEN rest * 2 > 64 OR (rest * 2 = 64 AND low % 2 = 1) THEN 1 ELSE 0 END AS r
                FROM shares)
    SELECT o_orderkey,
           (q // 100) || CASE WHEN q % 100 = 0 THEN '' ELSE '.' || rtrim(lpad((q % 100)::VARCHAR, 2, '0'), '0') END || '%' AS used,
           (r // 100) || CASE WHEN r % 100 = 0 THEN '' ELSE '.' || rtrim(lpad((r % 100)::VARCHAR, 2, '0'), '0') END || '%' AS rounded
    FROM rounded
""")
def format_ratio_decimals(spark, sf_dir):
    """Shares in ten-thousandths, and in sixty-fourths, which have more decimals than are shown, ties among them."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", display.used_share(F.lit(10000), 10000 - cents % 10000).alias("used"),
        display.used_share(F.lit(64), 64 - cents % 64).alias("rounded"))
