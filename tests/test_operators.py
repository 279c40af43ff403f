"""Operators on sample inputs with known results, on skewed keys and at awkward slice counts."""

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tests.conftest import rows
from tidewater import schemas
from tidewater.functions import text
from tidewater.operators import changelog, joins, latest, parsing, routing, running, slices, tables, windows


def ordered(spark, data, schema):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], f"i bigint, {schema}")
    return frame


def test_word_count(spark):
    frame = spark.createDataFrame([(v,) for v in ["hello,world", "scala,", "scala,world", ",aaaa"]], "value string")
    assert rows(tables.count_words(frame, text.split_on(F.col("value"), ","))) == [
        ("aaaa", 1), ("hello", 1), ("scala", 2), ("world", 2)]
    assert rows(tables.count_words(frame, text.split_on(F.col("value"), ","), keep_empty=True))[0] == ("", 1)


def test_sql_word_count(spark):
    frame = spark.createDataFrame([(w, 1) for w in "hello spark hello world".split()], "a string, b int")
    tables.register(frame, "words", "word,frequency")
    assert "words" in tables.view_names(spark)
    counted = spark.sql("select word as word, sum(frequency) as frequency from words GROUP BY word")
    assert rows(tables.as_records(counted, schemas.WORD_COUNT)) == [("hello", 2), ("spark", 1), ("world", 1)]


def test_table_select_where(spark):
    people = spark.createDataFrame([("name1", 10), ("name2", 20)], "a string, b int")
    assert rows(tables.named(people).select("f1").where("f1 > 10")) == [(20,)]
    assert rows(tables.named(people, "name,age").select("name").where("name='name2'")) == [("name2",)]
    assert rows(changelog.append_only(tables.named(people, "name,age"))) == [(True, "name1", 10), (True, "name2", 20)]


def test_union_and_connect(spark):
    shape = "product string, action string, user string"
    first = spark.createDataFrame([("productID1", "click", "user_1")], shape)
    second = spark.createDataFrame([("1", "1", "1")], shape)
    third = spark.createDataFrame([a for a in fx.ACTIONS if a[0] == "productID2"], shape)
    united = routing.union(first, second, third)
    assert united.count() == 5
    texts = spark.createDataFrame([("productID3:click:user_1",), ("productID3:browse:user_2",)], "t string")
    both = routing.connect(united, texts, text.join_fields(",", *[F.col(c) for c in united.columns]),
                           text.rejoin_first_two(F.col("t")))
    assert rows(both) == sorted([("productID1,click,user_1",), ("1,1,1",), ("productID2,browse,user_1",),
                                 ("productID2,click,user_2",), ("productID2,click,user_1",),
                                 ("productID3>>click",), ("productID3>>browse",)])


def test_split_and_side_output(spark):
    actions = spark.createDataFrame([*fx.ACTIONS, (None, "click", "user_9")], schemas.ACTION)
    tagged = routing.tag(actions, {n: F.col("product") == n for n in ("productID1", "productID2")})
    assert rows(routing.select_output(tagged, "productID1")) == sorted(a for a in fx.ACTIONS if a[0] == "productID1")
    assert routing.select_output(tagged, "productID1", "productID2").count() == 6
    main, side = routing.side_output(actions, F.col("product") == "productID2")
    assert (main.count(), side.count()) == (4, 3)


def test_sort(spark):
    people = spark.createDataFrame([("u1", 23), ("u2", 22), ("u3", 21), ("u4", 24)], "id string, age int")
    ranked = running.sorted_with_rank(people, ["age", "id"])
    assert [tuple(r) for r in ranked.select("id", "position").collect()] == [("u3", 1), ("u2", 2), ("u1", 3), ("u4", 4)]


@pytest.mark.parametrize("count", [None, 3, 1000])
def test_running(spark, count):
    users = parsing.parse_event_json(ordered(spark, [(v,) for v in fx.USER_EVENTS], "value string"), keep=("i",)).kept
    counted = running.running_sum(users.withColumn("one", F.lit(1)), ["userID"], ["i"], "one", slices=count)
    assert [r[0] for r in counted.orderBy("i").select(F.concat_ws(" : ", "userID", "total")).collect()] == fx.USER_COUNTS

    pairs = ordered(spark, fx.PAIRS, "key bigint, v bigint")
    means = running.pair_average(pairs, ["key"], ["i"], "v", slices=count)
    assert [tuple(r) for r in means.orderBy("pair_no").select("key", "average").collect()] == fx.PAIR_MEANS
    padded = running.pair_average_padded(pairs, "key", ["i"], "v", slices=count)
    assert [tuple(r) for r in padded.orderBy("i").select("key", "average").collect()] == fx.PAIR_MEANS_PADDED
    odd = running.pair_average_padded(pairs.where("i < 3"), "key", ["i"], "v", slices=count)
    assert [tuple(r) for r in odd.orderBy("i").select("key", "average").collect()] == [(0, 0), (2, 2), (0, 0)]

    behavior = ordered(spark, fx.BEHAVIOR, "userId bigint, behavior string, product string")
    seen = running.running_count(behavior, ["userId", "behavior"], ["i"], slices=count)
    assert [tuple(r) for r in seen.orderBy("i").select("userId", "behavior", "n").collect()] == fx.BEHAVIOR_COUNTS
    buys = tables.equal_to(behavior, "behavior", "buy").select("i", "userId")
    both = running.running_count(
        running.running_count(buys, ["userId"], ["i"], "mine", count), [], ["i"], "total", count, same_rows=buys)
    assert [tuple(r) for r in both.orderBy("i").select("userId", "mine", "total").collect()] == [
        (1, 1, 1), (1, 2, 2), (2, 1, 3), (2, 2, 4)]


@pytest.mark.parametrize("count", [1, 4, 1000])
def test_expiry_boundary(spark, count):
    seconds = [0, 9, 18, 28, 29, 50, 59, 60]
    frame = spark.createDataFrame([(i, s, "k") for i, s in enumerate(seconds)], "i bigint, s bigint, key string")
    frame = frame.withColumn("ts", F.timestamp_seconds("s"))
    counted = running.running_count_with_expiry(frame, ["key"], ["ts", "i"], "ts", "10 seconds", slices=count)
    assert [r.n for r in counted.orderBy("i").collect()] == [1, 2, 3, 1, 2, 1, 2, 3]


def test_empty_input(spark):
    nothing = spark.createDataFrame([], "i bigint, key string, v bigint")
    assert running.running_count(nothing, ["key"], ["i"]).count() == 0
    assert running.running_count(nothing, [], ["i"], slices=1000).count() == 0
    assert changelog.count_changes(nothing, ["key"], ["i"]).count() == 0


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows have one key, a third of them one instant; some keys are null."""
    return spark.range(30_000).select(
        "id",
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 != 0, F.concat(F.lit("k"), F.col("id") % 500)).alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(5000)).otherwise(F.col("id") % 10_000).alias("at"),
        (F.col("id") % 11).alias("v")).persist()


@pytest.mark.parametrize("count", [40, 400])
def test_skewed_keys_are_cut(spark, skewed, count):
    cut = slices.slice_rows(skewed, ["key"], ["at", "id"], count)
    largest = cut.rows.groupBy("key", slices.SLICE).count().agg(F.max("count")).first()[0]
    assert largest < 12 * 30_000 / count
    total = slices.slice_rows(skewed, [], ["at", "id"], count)
    assert total.rows.groupBy(slices.SLICE).count().agg(F.max("count")).first()[0] < 12 * 30_000 / count


@pytest.mark.parametrize("count", [40, 400])
def test_skewed_results(spark, skewed, count):
    skewed.createOrReplaceTempView("skewed")
    got = running.running_sum(skewed, ["key"], ["at", "id"], "v", slices=count).select("id", "total")
    wanted = spark.sql("select id, sum(v) over (partition by key order by at, id rows unbounded preceding) total from skewed")
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0
    got = running.running_count(skewed, [], ["at", "id"], slices=count).select("id", "n")
    wanted = spark.sql("select id, cast(row_number() over (order by at, id) as bigint) n from skewed")
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0


def test_windows(spark):
    data = [(1, "a,3"), (2, " a,7 "), (4, "b,1"), (6, "a,2")]
    frame = spark.createDataFrame(data, "s bigint, value string").withColumn("at", F.timestamp_seconds("s"))
    pairs = parsing.parse_csv_pair(frame, keep=("at",)).kept
    first, second = ("1970-01-01 00:00:00", "1970-01-01 00:00:05"), ("1970-01-01 00:00:05", "1970-01-01 00:00:10")
    assert rows(windows.window_max(pairs, "at", "5 seconds", "event", F.col("pv"))) == [
        ("a", *first, 7), ("a", *second, 2), ("b", *first, 1)]
    sums = windows.window_count_sum(pairs, "at", "5 seconds", "event", F.col("pv"))
    assert rows(sums) == [("a", *first, 2, 10), ("a", *second, 1, 2), ("b", *first, 1, 1)]
    newest = latest.latest(sums, ["event"], ["window_end"])
    assert rows(newest) == [("a", *second, 1, 2), ("b", *first, 1, 1)]
    assert rows(latest.look_up(newest, "event", ["b", "c"])) == [("b", *first, 1, 1)]


def logs(spark):
    def parse(texts, schema):
        frame = spark.createDataFrame([(t,) for t in texts], "value string")
        return joins.log_times(parsing.parse_json_records(frame, schema).kept)

    return (parse([fx.browse(s) for s in fx.BROWSE_SECONDS], schemas.BROWSE_LOG),
            parse([fx.click(s) for s in fx.CLICK_SECONDS], schemas.CLICK_LOG))


def second(column):
    return F.substring(column, -2, 2).cast("int")


@pytest.mark.parametrize("how", ["inner", "left", "right"])
def test_joins(spark, how):
    browse, click = logs(spark)
    joined = joins.window_join(browse, click, how, "ts", "10 seconds", ["userID", "eventTime"])
    assert rows(joined.select(second("left_eventTime"), second("right_eventTime"))) == sorted(fx.JOINED[how], key=repr)
    lines = [r[0] for r in rows(joins.render_join(joined, how))]
    assert len(lines) == len(fx.JOINED[how])
    if how == "right":
        assert ("null ==Right Join=> UserClickLog{userID='user_2', eventTime='2019-11-16 17:30:03', eventType='click', "
                "pageID='page_1'}") in lines
    if how == "inner":
        assert lines[0] == (
            "UserBrowseLog{userID='user_2', eventTime='2019-11-16 17:30:01', eventType='browse', productID='product_1', "
            "productPrice=10} ==Inner Join=> UserClickLog{userID='user_2', eventTime='2019-11-16 17:30:01', "
            "eventType='click', pageID='page_1'}")


def test_null_users(spark):
    side = spark.sql("select cast(null as string) userID, 't' eventTime, timestamp'2020-01-01 00:00:00' ts")
    keys = ["userID", "eventTime"]
    assert joins.window_join(side, side, "left", "ts", "10 seconds", keys).count() == 0
    assert joins.window_join(side, side, "inner", "ts", "10 seconds", keys, null_keys="as_text").count() == 1


def test_cogroup(spark):
    browse, click = logs(spark)
    members = joins.cogroup_rows(browse, click, "ts", "10 seconds", ["userID", "eventTime"], second("eventTime"), second("eventTime"))
    assert members.count() == len(fx.BROWSE_SECONDS) + len(fx.CLICK_SECONDS)
    groups = joins.cogroup_summary(members, ["userID", "eventTime"])
    assert rows(groups.select(second("eventTime"), "n_left", "n_right")) == [
        (1, 1, 1), (10, 1, 1), (2, 1, 1), (3, 0, 1), (5, 1, 0)]


def test_hot_join_key_is_split(spark):
    """A key with most rows of one side must not end up in one task."""
    left = spark.range(200_000).select(F.lit("hot").alias("userID"), F.col("id"), F.lit("t").alias("eventTime"),
                                       F.timestamp_seconds(F.lit(0)).alias("ts"), F.rpad(F.lit("x"), 100, "x").alias("pad"))
    left = left.union(spark.range(20_000).select(F.concat(F.lit("u"), "id"), "id", F.lit("t"), F.timestamp_seconds(F.lit(0)), F.lit("p")))
    right = left.where("id < 20000").dropDuplicates(["userID"]).drop("pad")
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        joined = joins.window_join(left.repartition(8), right, "inner", "ts", "10 seconds", ["userID", "eventTime"])
        assert len(joined.collect()) == 220_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_enrichment_sizes(spark):
    people = spark.createDataFrame([("u", 1), ("v", 2)], "userID string, age int")
    events = spark.createDataFrame([("u",), ("w",)], "userID string")
    joined = joins.enrich(events, people, "userID")
    assert rows(joined) == [("u", 1)]
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()


def test_changes(spark):
    frame = ordered(spark, [("a",), ("b",), ("a",), ("a",)], "key string")
    assert rows(changelog.count_changes(frame, ["key"], ["i"])) == sorted([
        ("a", True, 1), ("a", False, 1), ("a", True, 2), ("a", False, 2), ("a", True, 3), ("b", True, 1)], key=repr)


def test_default_slices_of_a_large_key(spark, skewed, monkeypatch):
    """Cuts come from one row in ``CANDIDATE``; without any, the table is one slice."""
    monkeypatch.setattr(slices, "CANDIDATE", 20)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        cut = slices.slice_rows(skewed, ["key"], ["at", "id"])
        largest = cut.rows.groupBy("key", slices.SLICE).count().agg(F.max("count")).first()[0]
        assert largest < 15_000 / 8
        skewed.createOrReplaceTempView("skewed")
        got = running.running_count(skewed, ["key"], ["at", "id"]).select("id", "n")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    wanted = spark.sql("select id, row_number() over (partition by key order by at, id) n from skewed")
    assert got.exceptAll(wanted).count() == 0 and got.count() == 30_000
    monkeypatch.setattr(slices, "CANDIDATE", 10**9)
    one = running.running_count(skewed, ["key"], ["at", "id"]).select("id", "n")
    assert one.exceptAll(wanted).count() == 0


def test_rows_with_columns_that_have_no_hash(spark):
    rows = spark.sql("select id, id % 3 as k, map('a', id) as m, parse_json('{}') as v from range(50)")
    got = running.running_count(rows, ["k"], ["id"], slices=7).orderBy("id").select("n", "m").collect()
    assert [r["n"] for r in got] == [i // 3 + 1 for i in range(50)] and got[9]["m"] == {"a": 9}
