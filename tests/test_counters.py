"""Counter maps."""

import json
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallystream.operators import (
    counters_to_json,
    explode_counters,
    insert_defaults,
    lookup_stored,
    merge_counters,
    sum_counters,
)
from tests.conftest import rows

SCHEMA = "user_id long, general_stats string"


def maps(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def test_null_and_empty_maps_give_no_rows(spark):
    df = maps(spark, (1, None), (2, "{}"), (3, '{"a":1}'))
    assert rows(explode_counters(df)) == [(3, "a", "1")]


def test_values_may_be_text_and_null(spark):
    df = maps(spark, (1, '{"a":"4","b":null}'), (1, '{"a":3}'))
    assert rows(sum_counters(explode_counters(df))) == [(1, "a", 7), (1, "b", None)]
    merged = counters_to_json(sum_counters(explode_counters(df)))
    assert rows(merged) == [(1, '{"a":7,"b":null}')]


@pytest.mark.parametrize("value", ['"x"', "1.5", '{"n":1}', "[1]", "true", '""'])
def test_value_that_is_no_integer_fails(spark, value):
    df = maps(spark, (1, '{"a":%s}' % value))
    with pytest.raises(Exception, match="counter is not an integer"):
        sum_counters(explode_counters(df)).collect()


def test_malformed_map_fails(spark):
    with pytest.raises(Exception):
        explode_counters(maps(spark, (1, '{"a":1'))).collect()


def test_last_value_of_a_repeated_key_wins(spark):
    df = maps(spark, (1, '{"a":1,"b":5,"a":2,"a":3}'))
    assert rows(explode_counters(df)) == [(1, "a", "3"), (1, "b", "5")]


def test_keys_come_in_order(spark):
    df = maps(spark, (1, '{"z":1,"a":2}'), (1, '{"m":3}'))
    assert rows(counters_to_json(sum_counters(explode_counters(df)))) == [
        (1, '{"a":2,"m":3,"z":1}')
    ]


def test_merge_is_a_union_of_keys(spark):
    stored = maps(spark, (1, '{"a":1,"b":2}'), (9, '{"a":100}'))
    delta = maps(spark, (1, '{"b":3,"c":4}'), (2, '{"a":1}'), (1, "{}"))
    assert rows(merge_counters(delta, stored)) == [
        (1, '{"a":1,"b":5,"c":4}'),
        (2, '{"a":1}'),
    ]


def test_empty_delta_rewrites_the_stored_map(spark):
    stored = maps(spark, (1, '{"b":2,"a":1}'), (2, None))
    delta = maps(spark, (1, "{}"), (2, "{}"), (3, "{}"))
    assert rows(merge_counters(delta, stored)) == [(1, '{"a":1,"b":2}')]


def test_sums_pass_the_int_range(spark):
    stored = maps(spark, (1, '{"a":3000000000}'))
    assert rows(merge_counters(stored, stored)) == [(1, '{"a":6000000000}')]


def test_lookup(spark):
    stored = maps(spark, (1, '{"a":1}'))
    delta = maps(spark, (1, "{}"), (2, "{}"))
    assert rows(lookup_stored(delta, stored)) == [(1, "{}", '{"a":1}'), (2, "{}", None)]


def test_first_insert(spark):
    row = insert_defaults(maps(spark, (5, '{"a":1}'))).first()
    assert row.user_fkey == "fobj__sb_user_profile__5"
    assert row.version == 1
    assert row.created == row.updated
    assert {row.details, row.this_week, row.last_week, row.last_30_days, row.last_90_days} == {"{}"}
    fixed = insert_defaults(
        maps(spark, (5, "{}")), F.lit("2024-01-01").cast("timestamp")
    ).first()
    assert fixed.created.year == 2024


counter_maps = st.dictionaries(
    st.sampled_from(["won", "loss", "k", "ключ", 'quo"te', "sp ace"]), st.integers(-5, 5), max_size=4
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(1, 3), counter_maps), min_size=1, max_size=12),
    st.dictionaries(st.integers(1, 4), counter_maps, max_size=4),
)
def test_merge_equals_plain_python(spark, delta, stored):
    expected = {}
    for user in {u for u, _ in delta}:
        total = Counter()
        for counters in [m for u, m in delta if u == user] + [stored.get(user, {})]:
            for key, value in counters.items():
                total[key] += value
        if total:
            expected[user] = dict(total)
    merged = merge_counters(
        maps(spark, *((u, json.dumps(m)) for u, m in delta)),
        spark.createDataFrame([(u, json.dumps(m)) for u, m in stored.items()], SCHEMA),
    )
    assert {u: json.loads(text) for u, text in rows(merged)} == expected


@pytest.mark.parametrize(
    "text",
    ['{"a":1}{"b":2}', '{"a":1},', "", "null", '{"a":1', '{"a":1}],"x":[1', '{"a":1}],"one":[{"a":2}'],
)
def test_counter_map_refuses_other_text(spark, text):
    rows = spark.createDataFrame([(1, text)], "user_id long, general_stats string")
    with pytest.raises(Exception, match="not one JSON object|MALFORMED|Malformed"):
        explode_counters(rows).collect()
