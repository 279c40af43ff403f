"""Streams: golden results, equality with batch, late rows, restarts, expiry, changing dimensions."""

import json
import time

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tests.conftest import rows
from tidewater import schemas
from tidewater.functions import text, times
from tidewater.operators import changelog, joins, latest, parsing, routing, running, tables, windows
from tidewater.plans import jobs
from tidewater.sinks import tables as sinks
from tidewater.sources.rows import watch_lines
from tidewater.streaming import carried, processors
from tidewater.streaming.dimension import Snapshot, enrich_batches
from tidewater.streaming.queries import finish, published_state, to_batches, to_console, to_files, writer


def run(stream, place, **options):
    finish(to_files(stream, f"{place}/out", f"{place}/checkpoint", **options))
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{place}/out")


def test_page_views(spark, lines, tmp_path):
    """Two closed windows; the third stays open. Bad lines change nothing."""
    folder, drop = lines
    drop(*fx.PV_EVENTS[:3], "not json", "")
    drop(*fx.PV_EVENTS[3:])
    got = run(jobs.page_views(watch_lines(spark, folder, files_per_batch=1)), tmp_path)
    assert [r[0] for r in rows(got.select("line"))] == fx.PV_LINES


def test_late_rows_change_nothing(spark, lines, tmp_path):
    folder, drop = lines
    drop(*fx.PV_EVENTS)
    stream = jobs.page_views(watch_lines(spark, folder, files_per_batch=1))
    run(stream, tmp_path)
    drop(fx.PV_EVENTS[0])
    drop(fx.PV_EVENTS[5].replace(":49", ":59"))
    got = run(stream, tmp_path)
    assert [r[0] for r in rows(got.select("line"))] == fx.PV_LINES


def test_restart_loses_and_repeats_nothing(spark, lines, tmp_path):
    folder, drop = lines
    stream = watch_lines(spark, folder)
    for part in (fx.PV_EVENTS[:2], fx.PV_EVENTS[2:5], fx.PV_EVENTS[5:]):
        drop(*part)
        got = run(stream, tmp_path)
    assert sorted(r[0] for r in got.collect()) == sorted(fx.PV_EVENTS)
    assert sorted(r[0] for r in run(stream, tmp_path).collect()) == sorted(fx.PV_EVENTS)


def test_restart_keeps_state(spark, lines, tmp_path):
    folder, drop = lines
    counted = jobs.user_counts(watch_lines(spark, folder))
    for part in (fx.USER_EVENTS[:3], fx.USER_EVENTS[3:]):
        drop(*part)
        got = run(counted, tmp_path)
    assert sorted(r[0] for r in got.collect()) == sorted(fx.USER_COUNTS)
    kept = published_state(spark, f"{tmp_path}/checkpoint", "total")
    assert rows(kept.select("key.userID", "value.total")) == [("user_2", 2), ("user_3", 1), ("user_5", 2)]


def test_processing_time_windows(spark, lines, tmp_path):
    """Arrival times are injected: a finite run has no later row that would close a real one."""
    folder, drop = lines
    drop("1;hello,world", "2;scala,", "4;,aaaa")
    drop("6;scala,world")
    drop("30;end")
    stamped = watch_lines(spark, folder, files_per_batch=1).select(
        F.timestamp_seconds(F.split_part("value", F.lit(";"), F.lit(1)).cast("bigint")).alias("ingest_ts"),
        F.split_part("value", F.lit(";"), F.lit(2)).alias("value"))
    got = run(jobs.window_word_count(stamped, "ingest_ts"), tmp_path)
    assert rows(got.select("word", F.substring("window_start", -2, 2), "frequency")) == [
        ("", "00", 1), ("aaaa", "00", 1), ("hello", "00", 1), ("scala", "00", 1), ("scala", "05", 1), ("world", "00", 1),
        ("world", "05", 1)]


@pytest.mark.parametrize("how", ["inner", "left", "right"])
def test_joins_equal_batch(spark, tmp_path, how):
    """A last pair far ahead closes all earlier windows."""
    folders = {}
    for side, texts in {"browse": [fx.browse(s) for s in (*fx.BROWSE_SECONDS, 59)],
                        "click": [fx.click(s) for s in (*fx.CLICK_SECONDS, 59)]}.items():
        folders[side] = tmp_path / side
        folders[side].mkdir()
        (folders[side] / "0.txt").write_text("\n".join(texts))

    def join(read):
        return jobs.join_logs(read(str(folders["browse"])), read(str(folders["click"])), how)

    stream = run(join(lambda p: watch_lines(spark, p)), tmp_path)
    assert rows(stream) == rows(join(spark.read.text))
    assert stream.count() == len(fx.JOINED[how]) + 1


def test_cogroup_members_stream(spark, lines, tmp_path):
    folder, drop = lines
    drop(*[fx.browse(s) for s in (1, 2)])
    clicks = tmp_path / "clicks"
    clicks.mkdir()
    (clicks / "0.txt").write_text(fx.click(1))
    members = jobs.group_logs(watch_lines(spark, folder), watch_lines(spark, str(clicks)))
    got = run(members.drop("window"), tmp_path)
    assert rows(got.select("side", F.substring("eventTime", -2, 2), F.substring("payload", 1, 14))) == [
        ("left", "01", "UserBrowseLog{"), ("left", "02", "UserBrowseLog{"), ("right", "01", "UserClickLog{u")]


def behavior_lines():
    return [",".join(map(str, r)) for r in fx.BEHAVIOR]


def behavior(frame):
    fields = F.split("value", ",")
    return frame.select(fields[0].cast("bigint").alias("userId"), fields[1].alias("behavior"))


def test_behavior_counts(spark, lines, tmp_path):
    folder, drop = lines
    drop(*behavior_lines()[:4])
    drop(*behavior_lines()[4:])
    counted = processors.count_per_item(behavior(watch_lines(spark, folder, files_per_batch=1)), ["userId"], "behavior")
    assert rows(run(counted, tmp_path)) == sorted(fx.BEHAVIOR_COUNTS)


def wait_for(condition, seconds=60):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end, "no result in time"
        time.sleep(0.5)


def test_behavior_counts_expire(spark, lines, tmp_path):
    folder, drop = lines
    counted = processors.count_per_item(behavior(watch_lines(spark, folder)), ["userId"], "behavior", ttl_millis=12_000)
    query = to_files(counted, f"{tmp_path}/out", f"{tmp_path}/checkpoint", every="1 second")

    def seen():
        try:
            return [r.n for r in spark.read.schema(counted.schema).parquet(f"{tmp_path}/out").collect()]
        except Exception:
            return []

    try:
        drop("1,buy,x")
        wait_for(lambda: len(seen()) == 1)
        drop("1,buy,x")
        wait_for(lambda: len(seen()) == 2)
        assert sorted(seen()) == [1, 2]
        time.sleep(14)
        drop("1,buy,x")
        wait_for(lambda: len(seen()) == 3)
        assert sorted(seen()) == [1, 1, 2]
    finally:
        query.stop()


@pytest.mark.parametrize("padded, expected", [(False, fx.PAIR_MEANS), (True, fx.PAIR_MEANS_PADDED)])
def test_pair_means(spark, lines, tmp_path, padded, expected):
    """Three files, so that one pair is open between two batches."""
    folder, drop = lines
    texts = [f"{k},{v}" for k, v in fx.PAIRS]
    for part in (texts[:3], texts[3:4], texts[4:]):
        drop(*part)
    pairs = parsing.parse_csv_pair(watch_lines(spark, folder, files_per_batch=1)).kept
    stream = processors.pair_average(pairs.select(F.col("event").cast("bigint").alias("key"), "pv"), "key", "pv", padded)
    assert rows(run(stream, tmp_path)) == sorted(expected, key=repr)


def test_changes_equal_batch(spark, lines, tmp_path):
    folder, drop = lines
    keys = ["a", "b", "a", "a", "c", "b", "a"]
    drop(*keys[:3])
    drop(*keys[3:])
    got = run(processors.count_changes(watch_lines(spark, folder, files_per_batch=1), "value"), tmp_path)
    frame = spark.createDataFrame(list(enumerate(keys)), "i bigint, value string")
    assert rows(got) == rows(changelog.count_changes(frame, ["value"], ["i"]))


def test_totals_and_shards(spark, lines, tmp_path):
    folder, drop = lines
    parsed = parsing.parse_csv_pair(watch_lines(spark, folder)).kept
    newest = sinks.LatestTable(f"{tmp_path}/totals", ["event"], ["total"])
    shards = sinks.LatestTable(f"{tmp_path}/shards", ["shard"], ["n"])
    for part in (["a,1", "b,2"], ["a,3", "a,4"]):
        drop(*part)
        finish(to_batches(processors.totals(parsed, ["event"], "pv"), newest.write_batch, f"{tmp_path}/c1", mode="update"))
        counted = processors.sharded_count(parsed, "pv", 3)
        finish(to_batches(counted, shards.write_batch, f"{tmp_path}/c2", mode="update"))
    assert rows(newest.read(spark)) == [("a", 8), ("b", 2)]
    assert published_state(spark, f"{tmp_path}/c1").select("key.event").count() == 2
    assert rows(processors.shard_total(shards.read(spark))) == [(4,)]


def test_split_outputs(spark, lines, tmp_path):
    folder, drop = lines
    drop(*[",".join(a) for a in fx.ACTIONS])
    product = F.split_part("value", F.lit(","), F.lit(1))
    tagged = routing.tag(watch_lines(spark, folder), {n: product == n for n in ("productID1", "productID2")})
    routed = tagged.select("value", F.explode(routing.OUTPUTS).alias("output"))
    got = run(routed, tmp_path, partition_by=["output"])
    assert got.where("output = 'productID1'").count() == got.where("output = 'productID2'").count() == 3


def test_table_views_on_streams(spark, lines, tmp_path):
    folder, drop = lines
    drop("name1,10", "name2,20")
    pairs = parsing.parse_csv_pair(watch_lines(spark, folder)).kept
    tables.register(pairs, "stream_people", "name,age")
    got = run(changelog.append_only(spark.sql("select name from stream_people where age > 10")), tmp_path)
    assert rows(got) == [(True, "name2")]


def test_changing_dimension(spark, lines, tmp_path):
    """Unknown users are dropped, a new snapshot replaces the old, a failing read keeps the last."""
    folder, drop = lines
    event = '{"userID": "user_3", "eventTime": "2019-08-17 12:19:47", "eventType": "browse", "productID": 1}'
    reads = [[], [("user_2", "Ann", 30), ("user_3", "Bo", 41)], None, [("user_2", "Ann", 31), ("user_5", "Cy", 22)]]

    def read():
        content = reads.pop(0)
        if content is None:
            raise OSError("source is down")
        return spark.createDataFrame(content, schemas.USER_INFO)

    snapshot = Snapshot(spark, read, schemas.USER_INFO, f"{tmp_path}/dimension", ttl_seconds=0.0)
    handle = enrich_batches(snapshot, "userID", sinks.append_batch(f"{tmp_path}/out"))
    events = jobs.events_to_enrich(watch_lines(spark, folder))
    sizes = []
    for _ in range(4):
        drop(event)
        finish(to_batches(events, handle, f"{tmp_path}/checkpoint"))
        sizes.append(sinks.read_batches(spark, f"{tmp_path}/out").count())
    assert sizes == [0, 1, 2, 2]
    assert rows(sinks.read_batches(spark, f"{tmp_path}/out").select("userName", "userAge")) == [("Bo", 41)] * 2


def test_snapshot_before_first_read_and_ttl(spark, tmp_path):
    now, calls = [0.0], []

    def read():
        calls.append(now[0])
        if len(calls) == 1:
            raise OSError("not there yet")
        return spark.createDataFrame([("u", "n", 1)], schemas.USER_INFO)

    snapshot = Snapshot(spark, read, schemas.USER_INFO, str(tmp_path / "d"), 3.0, clock=lambda: now[0])
    with pytest.raises(OSError):
        snapshot.refresh()
    assert snapshot.refresh().rows.count() == 1
    now[0] = 2.9
    snapshot.refresh()
    now[0] = 3.0
    snapshot.refresh()
    assert calls == [0.0, 0.0, 3.0]


def test_sinks_need_a_checkpoint(spark, lines):
    stream = watch_lines(spark, lines[0])
    with pytest.raises(ValueError):
        writer(stream, "")
    with pytest.raises(ValueError):
        to_console(stream, "")


def test_processors_refuse_unfit_names(spark, lines):
    with pytest.raises(ValueError, match="underscore"):
        processors.count_changes(watch_lines(spark, lines[0]).withColumnRenamed("value", "_v"), "_v")


def test_row_order_operators_refuse_streams(spark, lines):
    stream = watch_lines(spark, lines[0]).withColumn("i", F.lit(1))
    with pytest.raises(Exception):
        running.running_count(stream, ["value"], ["i"]).writeStream.format("noop").start()


def test_published_windows(spark, lines, tmp_path):
    """Window results go to a latest-value table and are looked up by key."""
    folder, drop = lines
    drop("1;a,3", "2; a,7 ", "4;b,1", "4;a", "4;a,x")
    drop("6;a,2")
    drop("30;end,0")
    stamped = watch_lines(spark, folder, files_per_batch=1).select(
        F.timestamp_seconds(F.split_part("value", F.lit(";"), F.lit(1)).cast("bigint")).alias("at"),
        F.split_part("value", F.lit(";"), F.lit(2)).alias("value"))
    peaks = sinks.LatestTable(f"{tmp_path}/peaks", ["event"], ["window_end"])
    counts = sinks.LatestTable(f"{tmp_path}/counts", ["event"], ["window_end"])
    finish(to_batches(jobs.window_peaks(stamped, "at"), peaks.write_batch, f"{tmp_path}/c1"))
    finish(to_batches(jobs.window_counts(stamped, "at"), counts.write_batch, f"{tmp_path}/c2"))
    assert rows(latest.look_up(peaks.read(spark), "event", ["a", "c"]).select("event", "pv")) == [("a", 2)]
    assert rows(counts.read(spark).select("event", "count", "sum")) == [("a", 1, 2), ("b", 1, 1)]


def test_host_messages(spark, lines, tmp_path):
    folder, drop = lines
    drop(fx.HOST_LINE, "too|short")
    sent = run(jobs.host_messages(watch_lines(spark, folder), load_millis=F.lit(7)), tmp_path).first()
    assert sent.value == sent.key and sent.partition in range(3)
    assert sent.value == (
        "Computer{timeStamp=7, os_name='Linux', os_arch='null', os_version=0.0, total_cup=4, cup_ratio='12.5%', "
        "total_memory='7.63GB', memory_ratio='40.1%', java_version='null', java_vm_vendo='null', "
        "eventTime=1614562657466, reservedTime='2021-3-1 10:37:37'}")
    as_json = jobs.host_messages(spark.read.text(folder), "json", load_millis=F.lit(7)).first()[0]
    assert json.loads(as_json)["os_arch"] is None and json.loads(as_json)["total_cup"] == 4


def test_index_job(spark, lines, tmp_path):
    folder, drop = lines
    drop('{"id":"1","n":1}', '{"id":"2"}', "not json", "")
    drop('{"id":"1","n":2}')
    out = tmp_path / "index"
    out.mkdir()
    place = str(out)

    def connect():
        def send(index, docs):
            for identity, source in docs:
                with open(f"{place}/{index}-{identity}", "w") as target:
                    target.write(source)
            return ["ok"] * len(docs)

        return send

    handle = jobs.index_batches("product", F.get_json_object("value", "$.id"), connect, sinks.append_batch(f"{tmp_path}/dead"))
    finish(to_batches(watch_lines(spark, folder, files_per_batch=1), handle, f"{tmp_path}/checkpoint"))
    assert {p.name: p.read_text() for p in out.iterdir()} == {
        "product-1": '{"id":"1","n":2,"eventType":"product"}', "product-2": '{"id":"2","eventType":"product"}'}
    assert sinks.read_batches(spark, f"{tmp_path}/dead").count() == 0


def test_rejected_events(spark, lines, tmp_path):
    folder, drop = lines
    drop(fx.PV_EVENTS[0], "not json")
    got = run(jobs.rejected_events(watch_lines(spark, folder)), tmp_path)
    assert rows(got.select("value")) == [("not json",)] and got.first().rejected_at is not None


def numbered(frame):
    """``key,at,id,v`` lines."""
    fields = F.split("value", ",")
    return frame.select(fields[0].alias("key"), *[fields[i].cast("bigint").alias(n) for i, n in enumerate(("at", "id", "v"), 1)])


@pytest.mark.parametrize("slices", [2, 300])
def test_carried_batches_equal_batch(spark, lines, tmp_path, slices):
    """Micro-batches that carry totals and open pairs over give what one batch gives, in event order."""
    folder, drop = lines
    texts = [f"{'ab'[i % 3 == 0] if i % 5 else 'c'},{i // 4},{i},{i * 7 % 11}" for i in range(120)]
    source = numbered(watch_lines(spark, folder))
    for n, (start, end) in enumerate([(0, 31), (31, 32), (32, 120)]):
        drop(*reversed(texts[start:end]))
        sums = carried.running_sum_batches(f"{tmp_path}/totals", ["key"], ["at", "id"], "v",
                                           sinks.append_batch(f"{tmp_path}/sums"), fold_every=2, slices=slices)
        finish(to_batches(source, sums, f"{tmp_path}/c1"))
        pairs = carried.pair_average_batches(f"{tmp_path}/open", ["key"], ["at", "id"], "v",
                                             sinks.append_batch(f"{tmp_path}/pairs"), fold_every=2, slices=slices)
        finish(to_batches(source, pairs, f"{tmp_path}/c2"))
    whole = numbered(spark.createDataFrame([(t,) for t in texts], "value string"))
    wanted = running.running_sum(whole, ["key"], ["at", "id"], "v").select("id", "total")
    assert rows(sinks.read_batches(spark, f"{tmp_path}/sums").select("id", "total")) == rows(wanted)
    wanted = running.pair_average(whole, ["key"], ["at", "id"], "v").select("key", "average")
    assert rows(sinks.read_batches(spark, f"{tmp_path}/pairs").select("key", "average")) == rows(wanted)


def test_repeated_carried_batch(spark, tmp_path):
    handle = carried.running_sum_batches(f"{tmp_path}/totals", ["key"], ["id"], "v", sinks.append_batch(f"{tmp_path}/out"))
    for batch_id, data in [(0, [("a", 1, 5), (None, 4, 1)]), (1, [("a", 2, 1)]), (1, [("a", 2, 1)]), (2, [("a", 3, 1), (None, 5, 1)])]:
        handle(spark.createDataFrame(data, "key string, id int, v int"), batch_id)
    assert rows(sinks.read_batches(spark, f"{tmp_path}/out").select("id", "total")) == [
        (1, 5), (2, 6), (3, 7), (4, 1), (5, 2)]


def test_processors_keep_nulls_and_large_numbers(spark, lines, tmp_path):
    """Columns that pass through a processor come out as they went in; null keys are a key."""
    folder, drop = lines
    large = 2**53 + 1
    drop(f"a,{large},1", "a,,2", "b,,", ",7,5", ",,6")
    fields = F.split("value", ",")
    frame = watch_lines(spark, folder).select(
        F.when(fields[0] != "", fields[0]).alias("key"), fields[1].try_cast("bigint").alias("id"),
        fields[2].try_cast("bigint").alias("v"))
    got = run(processors.running_sum(frame, ["key"], "v"), tmp_path)
    assert sorted(got.select("key", "id", "v").collect(), key=repr) == sorted(frame_rows(spark, folder), key=repr)
    assert rows(got.groupBy("key").agg(F.max("total"))) == [("a", 3), ("b", 0), (None, 11)]


def frame_rows(spark, folder):
    fields = F.split("value", ",")
    return spark.read.text(folder).select(
        F.when(fields[0] != "", fields[0]).alias("key"), fields[1].try_cast("bigint").alias("id"),
        fields[2].try_cast("bigint").alias("v")).collect()


def test_null_key_changes(spark, lines, tmp_path):
    folder, drop = lines
    drop("1", "", "1", "")
    keys = watch_lines(spark, folder).select(F.col("value").try_cast("bigint").alias("key"))
    got = run(processors.count_changes(keys, "key"), tmp_path)
    assert rows(got) == sorted([(k, *c) for k in (1, None) for c in [(True, 1), (False, 1), (True, 2)]], key=repr)


def test_carried_counts_and_changes(spark, tmp_path):
    data = [("a", "buy", 1), ("a", "buy", 2), ("b", "buy", 3), ("a", "fav", 4), ("a", "buy", 5), (None, "fav", 6), (None, "fav", 7)]
    shape = "key string, item string, id int"
    counts = carried.running_count_batches(f"{tmp_path}/n", ["key", "item"], ["id"], sinks.append_batch(f"{tmp_path}/counts"))
    changes = carried.count_changes_batches(f"{tmp_path}/c", ["key"], ["id"], sinks.append_batch(f"{tmp_path}/changes"))
    for batch_id, part in enumerate([data[:3], data[3:6], data[6:]]):
        counts(spark.createDataFrame(part, shape), batch_id)
        changes(spark.createDataFrame(part, shape), batch_id)
    whole = spark.createDataFrame(data, shape)
    got = sinks.read_batches(spark, f"{tmp_path}/counts").select("id", "n")
    assert rows(got) == rows(running.running_count(whole, ["key", "item"], ["id"]).select("id", "n"))
    got = sinks.read_batches(spark, f"{tmp_path}/changes").drop("batch_id")
    assert rows(got) == rows(changelog.count_changes(whole, ["key"], ["id"]))


def test_console_jobs_write_every_row(spark, tmp_path):
    """The console shows the first rows of a micro-batch; the files hold all of them."""
    from tidewater.__main__ import show_and_write

    handle = show_and_write(str(tmp_path / "out"))
    handle(spark.range(50).selectExpr("cast(id as string) AS line"), 0)
    handle(spark.range(50).selectExpr("cast(id as string) AS line"), 0)
    assert sinks.read_batches(spark, str(tmp_path / "out")).count() == 50
