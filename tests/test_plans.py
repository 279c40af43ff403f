"""Physical plans: what must hold for them to work on far larger tables."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tests.conftest import SMALL
from tidewater.operators import parsing, slices
from tidewater.plans import catalogue
from tidewater.sinks import documents

BATCH = sorted(n for n in catalogue.load() if not n.startswith("stream_"))


def plan(spark, name):
    frame = driver.queries()[name](spark, SMALL)
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    found = set()
    for columns in re.findall(r"FileScan parquet \[([^\]]*)\]", text):
        found |= {c.split("#")[0] for c in columns.split(",") if c}
    return found


@pytest.mark.parametrize("name", BATCH)
def test_no_plan_bottlenecks(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "CollectLimit"):
        assert bad not in text
    lines = text.splitlines()
    for above, below in zip(lines, lines[1:], strict=False):
        if "Exchange SinglePartition" in above:
            assert "Aggregate" in below, "only aggregated rows may meet in one task"


@pytest.mark.parametrize("name, columns", [
    ("word_count", {"text"}),
    ("filter_equals", {"event_id", "user_id", "event_type"}),
    ("pv_tumbling", {"ts", "event_type"}),
    ("sort_by_attribute", {"p_partkey", "p_size"}),
    ("format_ratio", {"l_orderkey", "l_linenumber", "l_discount"}),
    ("running_count_by_user", {"ts", "event_id", "user_id"}),
    ("join_inner", {"event_id", "ts", "user_id", "event_type"}),
    ("enrich_broadcast", {"event_id", "ts", "user_id", "event_type", "props", "c_custkey", "c_name", "c_nationkey"}),
])
def test_columns_read(spark, name, columns):
    assert read_columns(plan(spark, name)) == columns


@pytest.mark.parametrize("name, pushed", [
    ("filter_equals", "EqualTo(event_type,purchase)"),
    ("buy_running_count", "EqualTo(event_type,purchase)"),
    ("state_lookup", "In(event_type, [absent,click,purchase,view])"),
    ("join_left", "EqualTo(event_type,view)"),
])
def test_filters_reach_the_scan(spark, name, pushed):
    formatted = driver.queries()[name](spark, SMALL)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert pushed in formatted


@pytest.mark.parametrize("name, shuffles", [
    ("json_extract", 0), ("union_all", 0), ("cogroup_rows", 0), ("word_count", 1), ("pv_tumbling", 1), ("cogroup_window", 1),
    ("upsert_last_by_id", 1), ("latest_window_max", 2)])
def test_shuffles(spark, name, shuffles):
    assert plan(spark, name).count("Exchange hashpartitioning") == shuffles


@pytest.mark.parametrize("name", ["json_extract", "json_rejected"])
def test_text_is_parsed_once(spark, name):
    optimized = driver.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json") == 1


def test_schemaless_text_is_parsed_once(spark):
    df = spark.createDataFrame([('{"a":1}', 1), ("{", 2)], "value string, k int")
    parsed = parsing.parse_dynamic_json(df)
    sent = documents.documents(parsed.kept, F.col("k"), F.col("value"), F.lit("x"), members=F.col("members"))
    for frame in (parsed.kept, parsed.rejected, sent):
        assert str(frame._jdf.queryExecution().optimizedPlan().toString()).count("VariantExpressionEvalUtils") == 1
    assert [r["source"] for r in sent.collect()] == ['{"a":1,"eventType":"x"}']


def finished_stages(spark):
    store, sums = spark.sparkContext._jsc.sc().statusStore(), {}
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None).iterator()
    while stages.hasNext():
        s = stages.next()
        if str(s.status()) == "COMPLETE":
            sums[s.stageId()] = (s.inputRecords(), s.shuffleWriteRecords())
    return sums


@pytest.mark.parametrize("name", ["running_count_by_user", "running_sum_by_user", "behavior_running_count",
                                  "behavior_count_ttl", "buy_running_count", "retract_running_count"])
def test_row_order_reads_twice_and_shuffles_once(spark, monkeypatch, name):
    monkeypatch.setattr(slices, "CANDIDATE", 16)
    rows = spark.read.parquet(f"{SMALL}/events.parquet").count()
    before = set(finished_stages(spark))
    driver.queries()[name](spark, SMALL).write.format("noop").mode("overwrite").save()
    found = [s for stage, s in finished_stages(spark).items() if stage not in before]
    assert sum(read for read, _ in found) == 2 * rows
    # The rows, a sixteenth of them as candidates, and what slices and cuts add up to.
    assert sum(written for _, written in found) < 1.4 * rows
