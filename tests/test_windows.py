"""Tumbling windows."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallystream.operators import tumble, tumble_sql, with_proctime
from tallystream.streaming import (
    await_guarded,
    closing_windows,
    closing_windows_sql,
    file_topic_writer,
    launch,
    table_writer,
    wait_closed,
    window_job,
)
from tallystream.streaming.jobs import launch_guarded
from tests.conftest import pick, rows, texts

SCHEMA = "user_fkey string, risk_amount int, ts timestamp"


def at(text):
    return datetime.fromisoformat(text)


def test_windows_are_half_open_and_epoch_aligned(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, at("2024-01-01 00:00:29.999")),
            ("a", 2, at("2024-01-01 00:00:30.000")),
            ("a", 4, at("2024-01-01 00:00:59.999")),
            ("b", 8, at("2024-01-01 00:00:00.000")),
            ("b", None, at("1969-12-31 23:59:59.000")),
        ],
        SCHEMA,
    )
    first, second = at("2024-01-01 00:00:00"), at("2024-01-01 00:00:30")
    end = at("2024-01-01 00:01:00")
    assert rows(tumble(df, on="ts")) == sorted(
        [
            ("a", first, second, 1.0),
            ("a", second, end, 6.0),
            ("b", first, second, 8.0),
            ("b", at("1969-12-31 23:59:30"), at("1970-01-01 00:00:00"), None),
        ],
        key=repr,
    )


def test_sql_and_fluent_agree(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").cast("string").alias("user_fkey"),
        (F.col("value") * 100).cast("int").alias("risk_amount"),
        "ts",
    )
    df.createOrReplaceTempView("both_forms")
    for size in ("30 seconds", "6 hours"):
        fluent, sql = tumble(df, "ts", size), tumble_sql(spark, "both_forms", "ts", size)
        assert fluent.schema == sql.schema
        assert rows(fluent) == rows(sql)


def test_float_is_rounded_from_an_exact_sum(spark):
    moment = at("2024-01-01 00:00:00")
    df = spark.createDataFrame([("a", 2**24, moment), ("a", 1, moment)], SCHEMA)
    assert tumble(df, "ts").first().total_risk_amount == 16777216.0
    assert tumble(df, "ts", exact=True).first().total_risk_amount == 16777217


def test_proctime_is_one_value_per_batch(spark):
    df = with_proctime(spark.range(1000))
    assert df.select("proctime").distinct().count() == 1


def _run(spark, folder, windows):
    """Picks arrive in two files, the second in a later window; no input after that."""
    source, table = f"{folder}/in", f"{folder}/out"

    def arrive(*messages):
        texts(spark, *messages).coalesce(1).write.mode("append").text(source)

    arrive(pick("u__1", 5), pick("u__1", 6, currency=331), pick("u__2", 7))
    query = window_job(
        spark.readStream.text(source),
        lambda df: table_writer(df, table),
        "windows_test",
        f"{folder}/checkpoints",
        windows=windows,
        every="500 milliseconds",
    )
    deadline = time.time() + 60
    while time.time() < deadline and not (query.lastProgress and query.lastProgress.batchId >= 1):
        time.sleep(0.1)
    time.sleep(2.5)
    arrive(pick("u__1", 9))
    while time.time() < deadline:
        if sum(s.numInputRows for p in query.recentProgress for s in p.sources
               if "FileStream" in s.description) >= 4:
            break
        time.sleep(0.1)
    wait_closed(query, size_seconds=2, timeout=60)
    return spark.read.parquet(table)


def _check(result):
    per_user = sorted((r.user_fkey, r.total_risk_amount) for r in result.collect())
    assert per_user == [("u__1", 9.0), ("u__1", 11.0), ("u__2", 7.0)]
    assert all(r.window_end - r.window_start == timedelta(seconds=2) for r in result.collect())
    assert dict(result.dtypes)["total_risk_amount"] == "float"


def test_last_window_closes_without_input(spark, folder):
    _check(_run(spark, folder, lambda df: closing_windows(df, "2 seconds")))


def test_last_window_closes_without_input_sql(spark, folder):
    _check(_run(spark, folder, lambda df: closing_windows_sql(df, "sql_windows", "2 seconds")))


def test_windows_as_messages(spark, folder):
    """K4 with files in place of the topic: times and sums as JSON."""
    moment = at("2024-01-01 00:00:00")
    stream_in = f"{folder}/in"
    spark.createDataFrame([("a", 3, moment)], SCHEMA).write.parquet(stream_in)
    stream = spark.readStream.schema(SCHEMA).parquet(stream_in).select(
        "user_fkey",
        F.col("ts").alias("window_start"),
        (F.col("ts") + F.expr("INTERVAL 30 SECONDS")).alias("window_end"),
        F.col("risk_amount").cast("float").alias("total_risk_amount"),
    )
    launch(
        file_topic_writer(stream, f"{folder}/topic"), "as_messages", f"{folder}/c", available_now=True
    ).awaitTermination()
    assert rows(spark.read.text(f"{folder}/topic")) == [
        (
            '{"user_fkey":"a","window_start":"2024-01-01T00:00:00.000Z",'
            '"window_end":"2024-01-01T00:00:30.000Z","total_risk_amount":3.0}',
        )
    ]


def test_open_windows_survive_a_restart(spark, folder):
    """A job stopped with an open window emits it after the restart, once."""
    source, table = f"{folder}/in", f"{folder}/out"

    def start():
        return window_job(
            spark.readStream.text(source),
            lambda df: table_writer(df, table),
            "restarted",
            f"{folder}/checkpoints",
            size="8 seconds",
            every="500 milliseconds",
        )

    texts(spark, pick("u__1", 5)).coalesce(1).write.text(source)
    first = start()
    deadline = time.time() + 60
    while time.time() < deadline and not (first.lastProgress and first.lastProgress.batchId >= 0):
        time.sleep(0.1)
    first.stop()
    texts(spark, pick("u__1", 9), pick("u__2", 1)).coalesce(1).write.mode("append").text(source)
    second = start()
    assert second.id == first.id
    wait_closed(second, size_seconds=8, timeout=90)
    sums = {}
    for row in spark.read.parquet(table).collect():
        sums[row.user_fkey] = sums.get(row.user_fkey, 0) + row.total_risk_amount
    assert sums == {"u__1": 14.0, "u__2": 1.0}


class _Progress:
    """A batch's report as a listener gets it."""

    def __init__(self, query, dropped):
        self.id, self.name = query.id, query.name
        self.stateOperators = [type("Operator", (), {"numRowsDroppedByWatermark": dropped})]


def test_guard_stops_a_job_that_drops_rows(spark, folder):
    """A batch that reports rows of closed windows ends the job, and the runner fails."""
    texts(spark, pick("u__1", 5)).write.text(f"{folder}/in")
    query = window_job(
        spark.readStream.text(f"{folder}/in"),
        lambda df: table_writer(df, f"{folder}/out"),
        "guarded",
        f"{folder}/checkpoints",
        size="2 seconds",
    )
    report = lambda n: type("Event", (), {"progress": _Progress(query, n)})
    query.guard.onQueryProgress(report(0))
    assert query.isActive
    query.guard.onQueryProgress(report(3))
    assert not query.isActive
    with pytest.raises(RuntimeError, match="3 rows fell into closed windows of guarded"):
        await_guarded(query)


def test_guard_sees_rows_that_spark_drops(spark, folder):
    """Real reports of a watermark that rows are behind, as after a clock was set back."""
    schema = "ts timestamp, n int"
    rows_of = lambda *t: spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, m), 1) for m in t], schema
    ).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    rows_of(50)
    stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
    counts = stream.withWatermark("ts", "0 seconds").groupBy(F.window("ts", "1 minute")).count()
    writer = counts.writeStream.format("parquet").option("path", f"{folder}/out")
    query = launch_guarded(writer, spark, "late", f"{folder}/checkpoints", "100 milliseconds")
    query.processAllAvailable()
    rows_of(59)
    query.processAllAvailable()
    rows_of(10, 11)
    query.awaitTermination(60)
    assert not query.isActive
    with pytest.raises(RuntimeError, match="2 rows fell into closed windows"):
        await_guarded(query)
