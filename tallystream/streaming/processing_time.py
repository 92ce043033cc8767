"""Processing-time windows that close without further input.

Spark moves a watermark only when rows arrive, so the last window of a quiet
topic would stay open. A heartbeat of one row per second is added before the
watermark. It is dropped after the aggregation, by a test on an aggregated
flag: a filter on plain columns would be pushed below the watermark and the
heartbeat with it.

A row's processing time is its micro-batch's, so no row is ever late, and a
watermark without delay loses nothing. Keep the trigger well below the window.

A clock that is set back breaks that: rows would fall into closed windows, and Spark drops
them without a word. ``LateGuard`` watches a job and stops it when a batch reports such
rows; what the batch dropped is then known, and nothing more is lost.
"""

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tallystream.operators.windows import WINDOW_SIZE, with_proctime


def heartbeat(spark: SparkSession) -> DataFrame:
    """One row per second with no user and no stake."""
    beats = (
        spark.readStream.format("rate")
        .option("rowsPerSecond", 1)
        .option("numPartitions", 1)
        .load()
    )
    return beats.select(
        F.lit(None).cast("string").alias("user_fkey"),
        F.lit(None).cast("int").alias("risk_amount"),
        F.lit(0).alias("is_pick"),
    )


def with_heartbeat(picks: DataFrame) -> DataFrame:
    """Picks and heartbeats with their processing time, under a watermark on it."""
    real = picks.select("user_fkey", "risk_amount", F.lit(1).alias("is_pick"))
    rows = with_proctime(real.unionByName(heartbeat(picks.sparkSession)))
    return rows.withWatermark("proctime", "0 seconds")


def closing_windows(
    picks: DataFrame, size: str = WINDOW_SIZE, exact: bool = False
) -> DataFrame:
    """Stake per window and user, each window emitted once, on close (append mode).

    Rows are pre-aggregated per task before the shuffle to the state store, and
    a window's state is dropped when it is emitted. ``exact`` keeps the bigint
    sum.
    """
    total = F.sum("risk_amount")
    sums = (
        with_heartbeat(picks)
        .groupBy(F.window("proctime", size).alias("w"), "user_fkey")
        .agg(
            (total if exact else total.cast("float")).alias("total_risk_amount"),
            F.sum("is_pick").alias("picks"),
        )
    )
    return sums.where(F.col("picks") > 0).select(
        "user_fkey",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "total_risk_amount",
    )


def closing_windows_sql(
    picks: DataFrame, table: str = "picks_data", size: str = WINDOW_SIZE, exact: bool = False
) -> DataFrame:
    """The same in SQL, over a stream registered as ``table``."""
    with_heartbeat(picks).createOrReplaceTempView(table)
    return picks.sparkSession.sql(
        f"""
        SELECT user_fkey,
               window.start AS window_start,
               window.end AS window_end,
               CAST(sum(risk_amount) AS {"BIGINT" if exact else "FLOAT"}) AS total_risk_amount
        FROM {table}
        GROUP BY window(proctime, '{size}'), user_fkey
        HAVING sum(is_pick) > 0
        """
    )


class LateGuard(StreamingQueryListener):
    """Stops a query when one of its batches drops rows of closed windows."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.dropped = spark, name, 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name == self.name and (dropped := _dropped(progress)):
            self.dropped += dropped
            query = self.spark.streams.get(str(progress.id))
            if query is not None:
                query.stop()

    def onQueryTerminated(self, event) -> None:
        pass

    def check(self) -> None:
        """Fails if rows were dropped; call it when the query has ended."""
        if self.dropped:
            raise RuntimeError(
                f"{self.dropped} rows fell into closed windows of {self.name}: the clock went back"
            )


def await_guarded(query: StreamingQuery) -> None:
    """Wait for the end of a query of ``window_job``; fails if its guard has stopped it."""
    try:
        query.awaitTermination()
    finally:
        guard = getattr(query, "guard", None)
        if guard is not None:
            guard.spark.streams.removeListener(guard)
            guard.check()


def wait_closed(query: StreamingQuery, size_seconds: float, timeout: float | None = None) -> None:
    """Stop a query over a finite input once all its windows are written.

    The input is used up when a batch holds heartbeats only. All picks were
    processed before that batch began, so their windows are closed by the first
    finished batch whose watermark is one window later. Fails if a batch dropped
    rows as late: the clock was then set back. No ``timeout`` waits without end.
    """
    deadline = float("inf") if timeout is None else time.time() + timeout
    target = None
    try:
        while time.time() < deadline:
            if not query.isActive:
                raise RuntimeError(f"query ended early: {query.exception()}")
            progress = query.lastProgress
            dropped = _dropped(progress)
            if dropped:
                raise RuntimeError(f"{dropped} rows fell into closed windows: the clock went back")
            if progress is not None and target is None:
                if not any(_has_picks(source) for source in progress.sources):
                    target = _epoch(progress.timestamp) + size_seconds
            elif progress is not None:
                mark = progress.eventTime.get("watermark")
                if mark is not None and _epoch(mark) >= target:
                    return
            time.sleep(0.1)
        raise TimeoutError(f"windows still open after {timeout} s")
    finally:
        query.stop()


def _dropped(progress) -> int:
    """Rows that the last batch dropped because their window was closed."""
    operators = [] if progress is None else progress.stateOperators
    return sum(operator.numRowsDroppedByWatermark for operator in operators)


def _has_picks(source) -> bool:
    return "RateStream" not in source.description and source.numInputRows > 0


def _epoch(text: str) -> float:
    return datetime.fromisoformat(text).timestamp()
