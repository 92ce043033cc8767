"""F4-F7, A1, A2 on hand-made rows and against plain Python."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallystream.functions import parse_picks, stats_json, to_messages, user_key
from tallystream.operators import (
    contributions,
    insert_positional,
    merge_totals,
    user_totals,
)
from tallystream.schemas import PRINT_SINK, RIDE_SINK
from tests.conftest import pick, rows, texts


def totals(spark, *messages):
    return user_totals(contributions(parse_picks(texts(spark, *messages))))


def count_by_hand(picks):
    result = {}
    for user, risk, state, currency in picks:
        row = result.setdefault(user, [0, 0, 0, 0, 0])
        if currency == 333:
            row[0] += 1
            row[1] += risk
            for i, code in enumerate((511, 512, 513)):
                row[2 + i] += state == code
    return sorted((user, *row) for user, row in result.items())


def test_outcomes_and_gate(spark):
    messages = [
        pick(1, 10, 511),
        pick(1, 20, 512),
        pick(1, 30, 513),
        pick(1, 40, 501),
        pick(1, 50, 511, currency=331),
        pick(1, 60, 511, currency=None),
        pick(1, 70, None),
    ]
    assert rows(totals(spark, *messages)) == [(1, 5, 170, 1, 1, 1)]


def test_user_without_counting_picks_gets_zeros(spark):
    assert rows(totals(spark, pick(4, currency=331), pick(4, currency=None))) == [
        (4, 0, 0, 0, 0, 0)
    ]


def test_two_versions_of_a_pick_both_count(spark):
    first = pick(1, 10, 501, fkey="p__1", version=1)
    second = pick(1, 10, 511, fkey="p__1", version=2)
    assert rows(totals(spark, first, second, second)) == [(1, 3, 30, 2, 0, 0)]


def test_totals_pass_the_int_range(spark):
    big = 2_000_000_000
    assert rows(totals(spark, *[pick(1, big)] * 3))[0][2] == 3 * big


def test_merge_totals(spark):
    columns = "user_id long, total_picks long, total_coins_staked long, won long, loss long, push long"
    stored = spark.createDataFrame([(1, 5, 50, 1, 1, 1), (2, 1, 1, 0, 0, 0), (3, None, 7, 0, 0, 0)], columns)
    delta = spark.createDataFrame([(1, 1, 5, 1, 0, 0), (3, 2, 1, 0, 1, 0), (4, 1, 9, 0, 0, 1)], columns)
    assert rows(merge_totals(stored, delta)) == [
        (1, 6, 55, 2, 1, 1),
        (2, 1, 1, 0, 0, 0),
        (3, 2, 8, 0, 1, 0),
        (4, 1, 9, 0, 0, 1),
    ]


picks = st.lists(
    st.tuples(
        st.integers(1, 4),
        st.integers(-100, 2**31 - 1),
        st.sampled_from([501, 511, 512, 513]),
        st.sampled_from([331, 333, 333, 333]),
    ),
    min_size=1,
    max_size=30,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(picks, st.integers(0, 30))
def test_totals_and_merge_of_any_cut(spark, given_picks, cut):
    expected = count_by_hand(given_picks)
    everything = [pick(*p) for p in given_picks]
    assert rows(totals(spark, *everything)) == expected
    before, after = everything[:cut], everything[cut:]
    if before and after:
        merged = merge_totals(totals(spark, *before), totals(spark, *after))
        assert rows(merged) == expected


def test_hot_user_needs_no_more_rows_in_the_shuffle(spark):
    """A user with most rows: partial aggregation sends one row per task."""
    hot = spark.range(0, 20000, 1, 8).select(
        user_key(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id"))).alias("user_fkey"),
        F.lit(333).alias("currency_code"),
        F.lit(1).alias("risk_amount"),
        F.lit(511).alias("settlement_state"),
    )
    result = user_totals(contributions(hot)).where("user_id = 1").first()
    assert result.total_picks == 20000 - len(range(0, 20000, 3))


def test_json_forms(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "w long, l long, p long, s long, n long")
    text = df.select(stats_json(*(F.col(c) for c in "wlpsn"))).first()[0]
    assert text == (
        '{"won":1,"loss":2,"push":3,"total_coins_staked":4,"total_settled_picks":5}'
    )


def test_messages_state_null_fields(spark):
    df = spark.createDataFrame([("k", None)], "user_fkey string, risk_amount int")
    assert rows(to_messages(df, key="user_fkey")) == [
        ("k", '{"user_fkey":"k","risk_amount":null}')
    ]
    assert to_messages(df).columns == ["value"]


def test_positional_insert(spark):
    df = spark.createDataFrame([("u", 5)], "x string, y long")
    placed = insert_positional(df, PRINT_SINK)
    assert placed.schema == PRINT_SINK
    assert rows(placed) == [("u", 5)]
    with pytest.raises(ValueError, match="7 columns, the query 2"):
        insert_positional(df, RIDE_SINK)
