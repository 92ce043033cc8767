"""Positions stored with results; a lost checkpoint neither counts twice nor skips."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallystream.operators.totals import TOTALS
from tallystream.sources import start_options
from tallystream.streaming.jobs import pick_terms
from tallystream.streaming.manifest import Manifests
from tallystream.streaming.positions import PositionedLedger
from tests.conftest import pick, rows

RECORD = "topic string, partition int, offset long, value string"


def ledger(folder, **settings):
    return PositionedLedger(f"{folder}/table", keys=["user_id"], sums=TOTALS, **settings)


def records(spark, *places, user=None, topic="picks"):
    """A pick of 100 by user ``partition`` for each (partition, offset)."""
    made = [(topic, p, o, pick(p if user is None else user, 100)) for p, o in places]
    return spark.createDataFrame(made, RECORD)


def picks_of(table, spark):
    return {r.user_id: r.total_picks for r in table.read(spark).collect()}


def test_records_below_the_position_do_not_count_again(spark, folder):
    table = ledger(folder)
    table.add_records(records(spark, (0, 5), (0, 6), (1, 9)), "a", 0, pick_terms)
    assert rows(table.positions(spark)) == [("picks", 0, 7), ("picks", 1, 10)]
    # A new checkpoint reads from the start, and finds a new partition and later records.
    everything = records(spark, (0, 5), (0, 6), (1, 9), (0, 7), (2, 0))
    table.add_records(everything, "b", 0, pick_terms)
    assert picks_of(table, spark) == {0: 3, 1: 1, 2: 1}
    assert rows(table.positions(spark)) == [("picks", 0, 8), ("picks", 1, 10), ("picks", 2, 1)]


def test_a_replayed_batch_writes_nothing(spark, folder):
    table = ledger(folder)
    table.add_records(records(spark, (0, 0)), "a", 0, pick_terms)
    table.add_records(records(spark, (0, 0), (0, 1)), "a", 0, pick_terms)
    assert picks_of(table, spark) == {0: 1}
    assert table.batches(spark) == 1


def test_topics_have_positions_of_their_own(spark, folder):
    table = ledger(folder)
    table.add_records(records(spark, (0, 7)), "a", 0, pick_terms)
    table.add_records(records(spark, (0, 1), topic="other"), "a", 1, pick_terms)
    assert picks_of(table, spark) == {0: 2}


def test_empty_batches(spark, folder):
    table = ledger(folder)
    table.add_records(records(spark), "a", 0, pick_terms)
    assert picks_of(table, spark) == {} and rows(table.positions(spark)) == []
    table.add_records(records(spark, (0, 0)), "a", 1, pick_terms)
    table.add_records(records(spark), "a", 2, pick_terms)
    assert picks_of(table, spark) == {0: 1} and rows(table.positions(spark)) == [("picks", 0, 1)]


def test_levels_keep_sums_and_positions(spark, folder):
    table = ledger(folder, fold_every=2, keep_seconds=0.0)
    for n in range(6):
        table.add_records(records(spark, (0, n), (1, 2 * n), user=3), f"query{n % 2}", n, pick_terms)
    assert picks_of(table, spark) == {3: 12}
    assert rows(table.positions(spark)) == [("picks", 0, 6), ("picks", 1, 11)]
    runs = Manifests(spark, f"{folder}/table/query-all", 0.0).latest()[1]["runs"]
    assert len(runs) == 2  # six batches: runs of four and of two


def test_two_queries_at_once_count_a_record_once(spark, folder, monkeypatch):
    """The commit of one query comes between the other's look at the table and its commit."""
    table, other = ledger(folder), ledger(folder)
    commit, raced = Manifests.commit, []

    def late(self, number, content, replaced):
        if not raced:
            raced.append(number)
            other.add_records(records(spark, (0, 0), (0, 1)), "b", 0, pick_terms)
        return commit(self, number, content, replaced)

    monkeypatch.setattr(Manifests, "commit", late)
    table.add_records(records(spark, (0, 0), (0, 1), (0, 2)), "a", 0, pick_terms)
    assert picks_of(table, spark) == {0: 3}
    assert table.batches(spark) == 2


def test_crash_before_the_commit(spark, folder, monkeypatch):
    table = ledger(folder)

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(Manifests, "commit", fail)
        with pytest.raises(RuntimeError, match="lost"):
            table.add_records(records(spark, (0, 0)), "a", 0, pick_terms)
    assert rows(table.positions(spark)) == []
    table.add_records(records(spark, (0, 0)), "a", 0, pick_terms)
    assert picks_of(table, spark) == {0: 1}


@pytest.mark.parametrize("column", ["topic", "partition", "offset"])
def test_records_without_a_place_are_refused(spark, folder, column):
    bad = records(spark, (0, 0)).withColumn(column, F.lit(None).cast(dict(
        topic="string", partition="int", offset="long")[column]))
    with pytest.raises(Exception, match="without topic, partition or offset"):
        ledger(folder).add_records(bad, "a", 0, pick_terms)


def test_start_from_stored_positions(spark, folder):
    table = ledger(folder)
    table.add_records(records(spark, (0, 5), (2, 8)), "a", 0, pick_terms)
    start = table.starting_offsets(spark, {"picks": 3})
    assert start == {"picks": {"0": 6, "1": -2, "2": 9}}
    assert start_options(start) == {"startingOffsets": '{"picks": {"0": 6, "1": -2, "2": 9}}'}


def test_start_by_time():
    moment = datetime(2024, 1, 16, tzinfo=timezone.utc)
    assert start_options(moment) == {
        "startingTimestamp": "1705363200000",
        "startingOffsetsByTimestampStrategy": "latest",
    }
    with pytest.raises(ValueError, match="time zone"):
        start_options(datetime(2024, 1, 16))
