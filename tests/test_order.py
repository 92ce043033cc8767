"""Steps back are counted as a plain pass over the rows of a key counts them."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallystream.operators import order
from tallystream.operators.order import BATCH, PLACE, steps_back, with_arrival
from tallystream.schemas import RIDE_MESSAGE, RIDE_SINK
from tallystream.sources import json_table
from tallystream.streaming.jobs import arrival_writer, launch
from tallystream.streaming.journal import Journal
from tests.conftest import rows

ARRIVED = f"taxi string, n long, {BATCH} long, {PLACE} long"


def plain(data):
    """(key, n, batch, place) in any order, to the rows that ``steps_back`` gives."""
    found = {}
    for key, n, *_ in sorted(data, key=lambda r: r[2:]):
        one = found.setdefault(key, [0, 0, None, None])
        one[0] += 1
        if n is None:
            continue
        one[1] += one[3] is not None and n < one[3]
        one[2] = n if one[2] is None else one[2]
        one[3] = n
    return sorted(((k, *v) for k, v in found.items()), key=repr)


@pytest.mark.parametrize("bits", [0, 1, 2, 20])
@settings(deadline=None, max_examples=4, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.none() | st.integers(0, 5)), max_size=30))
def test_equals_a_plain_pass(spark, monkeypatch, bits, data):
    monkeypatch.setattr(order, "BLOCK_BITS", bits)
    placed = [(k, n, i // 8, (i % 8 // 4 << 33) + i % 4) for i, (k, n) in enumerate(data)]
    found = steps_back(spark.createDataFrame(placed[::-1], ARRIVED), "taxi", "n")
    assert rows(found) == plain(placed)


def test_extra_columns_with_the_same_names(spark):
    arrived = spark.createDataFrame([("a", 2, 0, 0), ("a", 1, 0, 1)], ARRIVED)
    clashing = arrived.selectExpr("*", "1 AS key", "2 AS sequence", "3 AS batch", "4 AS rows")
    assert rows(steps_back(clashing, "taxi", "n")) == [("a", 2, 1, 2, 1)]


def test_arrival_follows_the_rows_of_a_task(spark):
    placed = with_arrival(spark.range(0, 100, 1, 4), 7)
    assert rows(steps_back(placed.withColumn("k", F.lit(0)), "k", "id")) == [(0, 100, 0, 0, 99)]
    assert {r[BATCH] for r in placed.collect()} == {7}


def test_a_copy_out_of_order_is_found(spark, folder):
    """The second publication has earlier rides than the first."""
    journal = Journal(f"{folder}/table")
    text = '{"rideId":%d,"isStart":true,"eventTime":"t","lon":1.0,"lat":1.0,"psgCnt":1,"taxiId":5}'
    for ids in ((10, 11, 12), (3, 4, 20)):
        lines = spark.createDataFrame([(text % n,) for n in ids], "value string").coalesce(1)
        lines.write.mode("append").text(f"{folder}/topic")
        rides = json_table(
            spark.readStream.text(f"{folder}/topic"), RIDE_MESSAGE, message_schema=RIDE_MESSAGE, strict=True
        ).select("rideId", "taxiId", "isStart", "lon", "lat", "psgCnt", "eventTime")
        writer = arrival_writer(rides, RIDE_SINK, journal)
        launch(writer, "copy", f"{folder}/checkpoints", available_now=True).awaitTermination()
    copied = spark.read.parquet(*journal.folders(spark))
    assert rows(steps_back(copied, "taxiId", "rideId")) == [(5, 6, 1, 10, 20)]
