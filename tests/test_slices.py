"""K7: flushes by rows and by time, bounded retries, aborted writes leave nothing."""

import glob
import os

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallystream.schemas import PRINT_SINK
from tallystream.streaming.slices import SliceTable, SliceWriter, place, put_parquet, slices
from tests.conftest import rows


def batch(*numbers):
    return pa.RecordBatch.from_pydict({"n": pa.array(numbers, pa.int64())})


class Clock:
    """Each look at it takes a second."""

    def __init__(self):
        self.now = -1.0

    def __call__(self):
        self.now += 1.0
        return self.now


@settings(deadline=None)
@given(st.lists(st.integers(0, 9), max_size=6), st.integers(1, 7))
def test_slices_keep_rows_and_order(sizes, n):
    batches, at = [], 0
    for size in sizes:
        batches.append(batch(*range(at, at + size)))
        at += size
    cut = [t["n"].to_pylist() for t in slices(batches, n, 1e9)]
    assert sum(cut, []) == list(range(at))
    assert all(len(c) == n for c in cut[:-1]) and all(0 < len(c) <= n for c in cut)


def test_a_slice_goes_when_its_first_row_has_waited():
    found = list(slices([batch(1), batch(2), batch(3), batch(4)], 100, 2.0, Clock()))
    assert [t["n"].to_pylist() for t in found] == [[1, 2], [3, 4]]
    found = list(slices([batch(1), batch(2)], 100, 0.0))
    assert [t["n"].to_pylist() for t in found] == [[1], [2]]


def test_retries_are_counted_and_bounded(folder):
    trials = []

    def put(files, path, part, trial):
        trials.append((path.rsplit("-", 1)[1], trial))
        if trial < 2:
            raise OSError("refused")
        put_parquet(files, path, part, trial)

    def writer(retries):
        return SliceWriter({"path": folder, "rows": "2", "retries": retries, "pause": "0"}, put)

    done = writer("2").write(iter([batch(1, 2, 3)]))
    assert (done.rows, done.slices, done.retries) == (3, 2, 4)
    assert trials == [(f"{k}.parquet", t) for k in range(2) for t in range(3)]
    with pytest.raises(OSError, match="refused"):
        writer("1").write(iter([batch(1)]))
    assert glob.glob(f"{folder}/task-*") == [f"{folder}/{done.folder}"]
    writer("2").abort([done, None])
    assert glob.glob(f"{folder}/task-*") == []


def test_paths():
    assert place("/a/b")[1] == place("file:/a/b")[1] == place("file:///a/b")[1] == "/a/b"


def frame(spark, n, parts=3):
    keys = F.concat(F.lit("u"), F.col("id")).alias("user_fkey")
    return spark.range(0, n, 1, parts).select(keys, F.col("id").cast("int").alias("risk_amount"))


def test_batches_count_once(spark, folder):
    table = SliceTable(f"{folder}/table", rows=10)
    for number in (0, 0, 1):  # the first is replayed
        table.write(frame(spark, 50), "query", number)
    assert rows(table.read(spark, PRINT_SINK)) == rows(frame(spark, 50).unionAll(frame(spark, 50)))
    tasks = table.tasks(spark)
    assert sum(t["rows"] for t in tasks) == 100 and sum(t["retries"] for t in tasks) == 0
    assert len(tasks) == 6 and all(t["slices"] == 2 for t in tasks)


def test_empty_batches(spark, folder):
    table = SliceTable(f"{folder}/table")
    assert rows(table.read(spark, PRINT_SINK)) == []
    table.write(frame(spark, 0), "query", 0)
    assert rows(table.read(spark, PRINT_SINK)) == []
    table.write(frame(spark, 1, 4), "query", 1)
    assert rows(table.read(spark, PRINT_SINK)) == [("u0", 0)]


def test_nulls_and_long_texts(spark, folder):
    odd = spark.createDataFrame([(None, None), ("", 1), ("x" * 1_000_000, None)], PRINT_SINK)
    table = SliceTable(f"{folder}/table", rows=2)
    table.write(odd, "query", 0)
    assert rows(table.read(spark, PRINT_SINK)) == rows(odd)


def test_a_failed_write_leaves_no_slice(spark, folder):
    """A slice of one task never succeeds: the job fails, and the batch can be repeated."""

    def put(files, path, part, trial):
        if "u40" in part["user_fkey"].to_pylist():
            raise OSError("refused for good")
        put_parquet(files, path, part, trial)

    broken = SliceTable(f"{folder}/table", put, rows=10, retries=1, pause=0)
    with pytest.raises(Exception, match="refused for good"):
        broken.write(frame(spark, 50), "query", 0)
    assert broken.tasks(spark) == []
    assert glob.glob(f"{folder}/table/*/*/slice-*") == []
    assert not os.path.exists(f"{folder}/table/manifest-0")
    table = SliceTable(f"{folder}/table", rows=10)
    table.write(frame(spark, 50), "query", 0)
    assert rows(table.read(spark, PRINT_SINK)) == rows(frame(spark, 50))
