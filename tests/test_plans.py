"""Physical plans: what must be pruned, pushed, parsed once and shuffled once."""

import re

import pytest

import __spark_entry__ as driver
from tallystream.plans import QUERIES
from tallystream.functions import parse_picks
from tallystream.operators import contributions, user_totals
from tallystream.schemas import PICK_TABLE
from tallystream.sources import json_table
from tests.conftest import pick, texts

STREAMS = re.compile("stream|upsert|append|topic|insert|event_time|windows_messages|buckets")
BATCH = sorted(n for n in QUERIES if not STREAMS.search(n))
NARROW = [
    "pick_parse_json",
    "pick_table",
    "pick_project",
    "pick_contributions",
    "ride_copy",
    "publish_keyed_json",
    "raw_records",
    "counter_unnest",
]
ONE_SHUFFLE = ["user_stats", "user_stats_json", "counter_sum", "tumble_sql", "tumble_fluent"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", text)


@pytest.mark.parametrize("name", NARROW)
def test_narrow_queries_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ONE_SHUFFLE)
def test_one_shuffle_after_partial_aggregation(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text


@pytest.mark.parametrize(
    "name,columns",
    [
        ("pick_project", ["user_id", "value"]),
        ("user_stats", ["event_id", "user_id", "event_type", "value"]),
        ("counter_sum", ["user_id", "props"]),
        ("tumble_sql", ["ts", "user_id", "value"]),
    ],
)
def test_scan_reads_only_what_is_used(spark, sf_dir, name, columns):
    text = plan(QUERIES[name](spark, sf_dir))
    [schema] = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert [field.split(":")[0] for field in schema.split(",")] == columns


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(driver.queries()["user_stats_merge"](spark, sf_dir))
    assert "LessThan(ts,2024-01-16" in text
    assert "GreaterThanOrEqual(ts,2024-01-16" in text


def test_each_message_is_parsed_once(spark, folder):
    texts(spark, pick(1)).write.text(folder + "/t")
    source = spark.read.text(folder + "/t")
    totals = user_totals(contributions(parse_picks(source)))
    assert plan(totals).count("from_json(") == 1
    table = json_table(source, PICK_TABLE, strict=True).where("risk_amount > 5")
    assert plan(table.groupBy("user_fkey").sum("risk_amount")).count("from_json(") == 1


def test_merge_parses_each_side_once(spark, sf_dir):
    assert plan(driver.queries()["general_stats_merge"](spark, sf_dir)).count("from_json(") == 3


def test_merge_reads_each_side_once_and_joins_nothing(spark, sf_dir):
    text = plan(driver.queries()["general_stats_merge"](spark, sf_dir))
    assert text.count("FileScan") == 2 and "Join" not in text


def test_lookup_reads_the_touched_folders_only(spark, sf_dir):
    text = plan(driver.queries()["stored_lookup_buckets"](spark, sf_dir))
    assert "Python" not in text and text.count("FileScan") == 2


def test_maps_are_collected_after_one_shuffle(spark, sf_dir):
    """Rows are shuffled by user once, and lists are not shuffled."""
    stored = plan(driver.queries()["general_stats_upsert"](spark, sf_dir))
    assert stored.count("Exchange") == 1
    assert "Exchange hashpartitioning(user_id" in stored
    fresh = plan(driver.queries()["general_stats"](spark, sf_dir))
    assert fresh.count("Exchange") == 2
    assert re.search(r"collect_list.*\n.*partial_collect_list.*\n.*Exchange", fresh)
