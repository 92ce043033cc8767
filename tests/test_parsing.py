"""What the parse policies accept, refuse and set aside."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from tallystream.functions import parse_messages, parse_picks, quarantine, trailing_id
from tallystream.operators import contributions
from tallystream.schemas import PICK_MESSAGE, PICK_TABLE, RIDE_MESSAGE, RIDE_TABLE
from tallystream.sources import json_table
from tests.conftest import pick, rows, texts

SCHEMA = StructType().add("a", "integer").add("b", "string")

GOOD = [
    ('{"a":1,"b":"x"}', (1, "x")),
    ('{"b":"x","a":1,"c":[{"d":2}]}', (1, "x")),
    ('{"a":1,"a":2,"b":"x"}', (2, "x")),
    ('{"a":null,"b":null}', (None, None)),
    (' {"a":-2147483648,"b":""} ', (-2147483648, "")),
]

MALFORMED = [
    "",
    "  ",
    "null",
    "42",
    '"text"',
    "[]",
    '[{"a":1,"b":"x"}]',
    '{"a":1,"b":"x"',
    '{"a":1,"b":"x"} more',
    '{"a":1,"b":"x"}{"a":2,"b":"y"}',
    '{"a":1,"b":"x"},{"a":2,"b":"y"}',
    '{"a":1,"b":"x"}]}',
    '{"a":1,"b":"x"},',
    '{"a":1,"b":"x"}]',
    "{'a':1,'b':'x'}",
    '{"a":"7","b":"x"}',
    '{"a":7.0,"b":"x"}',
    '{"a":99999999999,"b":"x"}',
    '{"a":true,"b":"x"}',
]


@pytest.mark.parametrize("text,expected", GOOD)
def test_good_message(spark, text, expected):
    df = texts(spark, text)
    assert rows(parse_messages(df, SCHEMA)) == [expected]
    assert rows(parse_messages(df, SCHEMA, strict=True)) == [expected]
    assert rows(quarantine(df, SCHEMA, required=["a", "b"])) == [(*expected, None)]


@pytest.mark.parametrize("text", MALFORMED)
def test_malformed_message(spark, text):
    df = texts(spark, text)
    with pytest.raises(Exception):
        parse_messages(df, SCHEMA).collect()
    assert rows(quarantine(df, SCHEMA)) == [(None, None, text)]


def test_malformed_field_fails_even_if_not_selected(spark):
    df = texts(spark, '{"a":"7","b":"x"}')
    with pytest.raises(Exception):
        parse_messages(df, SCHEMA).select("b").collect()
    with pytest.raises(Exception):
        parse_messages(df, SCHEMA).count()


@pytest.mark.parametrize("text", ['{"b":"x"}', "{}", '{"A":1,"b":"x"}'])
def test_missing_field(spark, text):
    df = texts(spark, text)
    assert rows(parse_messages(df, SCHEMA))[0][0] is None
    with pytest.raises(Exception, match="missing field"):
        parse_messages(df, SCHEMA, strict=True).collect()
    with pytest.raises(Exception, match="missing field"):
        parse_messages(df, SCHEMA, strict=True).count()
    assert rows(quarantine(df, SCHEMA, required=["a"])) == [(None, None, text)]


def test_null_text_carries_no_row(spark):
    df = texts(spark, None, '{"a":1,"b":"x"}')
    assert rows(parse_messages(df, SCHEMA)) == [(1, "x")]
    assert rows(quarantine(df, SCHEMA)) == [(1, "x", None)]
    with pytest.raises(Exception, match="not one JSON object"):
        parse_picks(texts(spark, None)).collect()


def test_quarantine_splits_good_from_bad(spark):
    df = texts(spark, *[t for t, _ in GOOD], *MALFORMED)
    parsed = quarantine(df, SCHEMA)
    assert parsed.where(F.col("corrupt_record").isNull()).count() == len(GOOD)
    bad = parsed.where(F.col("corrupt_record").isNotNull())
    assert sorted(r.corrupt_record for r in bad.collect()) == sorted(MALFORMED)


def test_record_profile(spark):
    [row] = parse_picks(texts(spark, pick(7, risk=None, state=None, currency=None))).collect()
    assert (row.user_id, row.risk_amount) == (7, None)
    for key in (
        "user_fkey",
        "risk_amount",
        "settlement_state",
        "currency_code",
        "created_stamp_millis_utc",
    ):
        broken = pick(7).replace(f'"{key}"', '"other"')
        with pytest.raises(Exception):
            parse_picks(texts(spark, broken)).collect()


@pytest.mark.parametrize(
    "key,expected",
    [
        ("fobj__sb_user_profile__90", 90),
        ("u__+5", 5),
        ("u__-5", -5),
        ("u__ 5 ", 5),
        ("5", 5),
        ("a__b__0012", 12),
        ("a____5", 5),
        ("a___b__5", 5),
        ("_____5__6", 6),
    ],
)
def test_trailing_id(spark, key, expected):
    df = spark.createDataFrame([(key,)], "k string")
    assert df.select(trailing_id(F.col("k"))).first()[0] == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("key", ["x", "u__", "a___5", "a_____5", "a__5_", "u__5.5", "u__99999999999999999999", "", None])
def test_bad_key_fails_in_every_session(spark, key, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(key,)], "k string")
        with pytest.raises(Exception, match="no user id in key"):
            df.select(trailing_id(F.col("k"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_stake_is_needed_only_for_picks_that_count(spark):
    other = parse_picks(texts(spark, pick(1, risk=None, currency=331)))
    assert rows(contributions(other)) == [(1, 0, 0, 0, 0, 0)]
    counted = parse_picks(texts(spark, pick(1, risk=None)))
    with pytest.raises(Exception, match="no risk_amount"):
        contributions(counted).collect()


def test_whole_pick_message_with_selections(spark):
    text = pick(
        3, fkey="p__1", version=2, selections=[{"us_coeff": -155, "sport_id": 3901}, {}]
    )
    [row] = parse_messages(texts(spark, text), PICK_MESSAGE).collect()
    assert [s.us_coeff for s in row.selections] == [-155, None]
    assert isinstance(PICK_MESSAGE["selections"].dataType, ArrayType)
    assert len(PICK_MESSAGE.fields) == 19
    assert len(PICK_MESSAGE["selections"].dataType.elementType.fields) == 27


def test_table_ignores_undeclared_and_nulls_missing(spark):
    table = json_table(texts(spark, pick(3, selections=[])), PICK_TABLE, name="picks_test")
    [row] = spark.table("picks_test").collect()
    assert table.columns == PICK_TABLE.fieldNames()
    assert row.user_fkey.endswith("__3") and row.us_coeff is None


def test_settlement_time_holds_millis(spark):
    text = pick(3, settlement_stamp_millis_utc=1712235175054)
    [row] = json_table(texts(spark, text), PICK_TABLE).collect()
    assert row.settlement_stamp_millis_utc == 1712235175054


def test_columns_are_matched_by_name(spark):
    text = (
        '{"rideId":1,"isStart":true,"eventTime":"t","lon":1.5,"lat":2.5,"psgCnt":3,"taxiId":4}'
    )
    table = json_table(texts(spark, text), RIDE_TABLE, message_schema=RIDE_MESSAGE, strict=True)
    assert rows(table) == [(1, 4, True, 1.5, 2.5, 3, "t")]


def _by_hand(text):
    """What a strict reader of (a int, b text) makes of a text; None if it is bad."""
    try:
        found = json.loads(text)
    except ValueError:
        return None
    if type(found) is not dict:
        return None
    a, b = found.get("a"), found.get("b")
    if not (a is None or type(a) is int and -(2**31) <= a < 2**31):
        return None
    if not (b is None or type(b) is str):
        return None
    return (a, b)


def _texts(count):
    """Messages with random changes of one to three characters."""
    dice = random.Random(7)
    starts = [
        '{"a":1,"b":"x"}',
        '{"b":"y z","a":-20,"c":[1,{"d":null}]}',
        ' {"a" : null , "b":"\\u00e9\\n"} ',
        '{"c":{"a":5},"b":null}',
    ]
    marks = '{}[],:"ab1- \\tn\'.'
    for _ in range(count):
        text = list(dice.choice(starts))
        for _ in range(dice.randint(1, 3)):
            spot = dice.randrange(len(text))
            text[spot : spot + dice.randint(0, 1)] = dice.choice(marks) if dice.random() < 0.7 else ""
        yield "".join(text)


def test_damaged_messages_are_read_as_by_a_strict_reader(spark):
    damaged = sorted(set(_texts(4000)))
    df = spark.createDataFrame([(t,) for t in damaged], "value string")
    found = quarantine(df, SCHEMA, keep=["value"]).collect()
    assert len(found) == len(damaged)
    different = []
    for row in found:
        expected = _by_hand(row.value)
        mine = None if row.corrupt_record is not None else (row.a, row.b)
        if mine != expected:
            different.append((row.value, mine, expected))
    assert different == []
    good = [t for t in damaged if _by_hand(t) is not None]
    assert 100 < len(good) < len(damaged)
    strict_df = spark.createDataFrame([(t,) for t in good], "value string")
    assert sorted(rows(parse_messages(strict_df, SCHEMA)), key=repr) == sorted(
        (_by_hand(t) for t in good), key=repr
    )
    keys = [set(json.loads(t)) for t in good]
    reasons = quarantine(
        strict_df, SCHEMA, required=["a", "b"], reason="why", keep=["value"]
    ).collect()
    for row in reasons:
        missing = not {"a", "b"} <= set(json.loads(row.value))
        assert row.why == ("missing field" if missing else None)
    assert any({"a", "b"} <= k for k in keys)


@pytest.mark.parametrize("text", ['{"a":1}],"x":[1', '{"a":1}],"x":[{"a":2}', '{"a":1}],"__one":[{"a":2}'])
def test_text_that_reopens_the_list_is_refused(spark, text):
    schema = StructType().add("a", IntegerType())
    df = spark.createDataFrame([(text,)], "value string")
    with pytest.raises(Exception, match="not one JSON object|MALFORMED|Malformed"):
        parse_messages(df, schema, strict=True).collect()
    kept = quarantine(df, schema, reason="why").collect()
    assert [(r.a, r.corrupt_record, r.why) for r in kept] == [(None, text, "malformed")]
