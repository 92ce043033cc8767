"""Named streaming jobs.

A job is a source frame, operators, and a writer, started under a name. Name
and checkpoint folder belong together: a restart under the same name continues
where the last run stopped.
"""

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tallystream.functions.encoding import stats_json
from tallystream.functions.messages import parse_picks
from tallystream.operators.counters import explode_counters, sum_counters
from tallystream.operators.order import with_arrival
from tallystream.operators.projection import insert_positional, project
from tallystream.operators.totals import contributions, user_totals
from tallystream.operators.windows import WINDOW_SIZE
from tallystream.schemas import PICK_TABLE, PRINT_SINK, RIDE_MESSAGE, RIDE_SINK, RIDE_TABLE
from tallystream.sources.tables import json_table
from tallystream.sources.topics import raw_records
from tallystream.streaming.journal import Journal
from tallystream.streaming.positions import PLACE, PositionedLedger
from tallystream.streaming.processing_time import LateGuard, closing_windows
from tallystream.streaming.sinks import lines_writer

EVERY = "5 seconds"

# Writes one batch: rows, id of the query, number of the batch.
BatchWriter = Callable[[DataFrame, str, int], None]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder the cluster names.

    Only a session on one machine, with no shared folder set, uses a temporary
    folder of that machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def launch(
    writer: DataStreamWriter,
    name: str,
    checkpoints: str,
    every: str = EVERY,
    available_now: bool = False,
) -> StreamingQuery:
    """Start a writer under its name, with its checkpoint and trigger.

    ``available_now`` processes what is there and ends; the returned query can
    be awaited either way.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        writer.queryName(name)
        .option("checkpointLocation", f"{checkpoints.rstrip('/')}/{name}")
        .trigger(**trigger)
        .start()
    )


def each_batch(df: DataFrame, write: BatchWriter) -> DataStreamWriter:
    """A writer that hands each micro-batch to ``write`` with the query's id.

    Spark sets the id while it runs a batch. It is kept in the checkpoint, so it
    is the same after a restart and another one for a new checkpoint.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("the batch runs outside a streaming query")
        write(batch, query_id, batch_id)

    return df.writeStream.foreachBatch(run)


def totals_writer(contributed: DataFrame, write: BatchWriter) -> DataStreamWriter:
    """Totals of each micro-batch, added up by the sink (K1).

    The stream keeps no state: the stored totals are the state. Rows are narrowed
    to the contributions before the batch is handed over, as Spark does not
    prune columns across ``foreachBatch``.
    """
    return each_batch(contributed, lambda df, q, n: write(user_totals(df), q, n))


def totals_job(
    messages: DataFrame, write: BatchWriter, name: str, checkpoints: str, **run
) -> StreamingQuery:
    """Messages to running totals per user."""
    contributed = contributions(parse_picks(messages))
    return launch(totals_writer(contributed, write), name, checkpoints, **run)


def pick_terms(records: DataFrame) -> DataFrame:
    """What records add to the totals of their users, with their places in the topic."""
    place = [*PLACE, "offset"]
    texts = records.select(F.col("value").cast("string").alias("value"), *place)
    terms = contributions(parse_picks(texts, keep=place), keep=place)
    return terms.withColumnRenamed("total_risk_amount", "total_coins_staked")


def positioned_totals_job(
    records: DataFrame, ledger: PositionedLedger, name: str, checkpoints: str, **run
) -> StreamingQuery:
    """Records of a topic to running totals that outlive the checkpoint."""
    narrow = records.select("value", *PLACE, "offset")
    writer = each_batch(narrow, lambda df, q, n: ledger.add_records(df, q, n, pick_terms))
    return launch(writer, name, checkpoints, **run)


def pick_counters(contributed: DataFrame) -> DataFrame:
    """Contributions as one JSON counter map per pick (F8)."""
    text = stats_json(*map(F.col, ("won", "loss", "push", "total_risk_amount", "total_picks")))
    return contributed.select("user_id", text.alias("general_stats"))


def counters_writer(counters: DataFrame, write: BatchWriter) -> DataStreamWriter:
    """Counter sums of each micro-batch, merged by the sink (K2)."""
    return each_batch(
        counters, lambda df, q, n: write(sum_counters(explode_counters(df)), q, n)
    )


def totals_as_counters(contributed: DataFrame) -> DataFrame:
    """(user_id, key, total) of the totals, without a JSON round trip per pick."""
    totals = user_totals(contributed)
    names = {
        "won": "won",
        "loss": "loss",
        "push": "push",
        "total_coins_staked": "total_coins_staked",
        "total_settled_picks": "total_picks",
    }
    entries = F.create_map(*(c for k, v in names.items() for c in (F.lit(k), F.col(v))))
    return totals.select("user_id", F.explode(entries).alias("key", "total"))


def counters_job(
    messages: DataFrame, write: BatchWriter, name: str, checkpoints: str, **run
) -> StreamingQuery:
    """Messages to one counter map per user.

    The counters of a batch are summed as columns and turned into keys
    afterwards, one row per user and key.
    """
    contributed = contributions(parse_picks(messages))
    writer = each_batch(contributed, lambda df, q, n: write(totals_as_counters(df), q, n))
    return launch(writer, name, checkpoints, **run)


def window_job(
    messages: DataFrame,
    writer_of: Callable[[DataFrame], DataStreamWriter],
    name: str,
    checkpoints: str,
    size: str = WINDOW_SIZE,
    every: str = "1 second",
    windows: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Messages to processing-time windows, each written once, on close.

    ``windows`` replaces the default aggregation, for example by its SQL form. A guard
    stops the query should the clock go back; ``await_guarded`` then fails.
    """
    picks = json_table(messages, PICK_TABLE)
    closed = closing_windows(picks, size) if windows is None else windows(picks)
    return launch_guarded(writer_of(closed), messages.sparkSession, name, checkpoints, every)


def launch_guarded(
    writer: DataStreamWriter, spark: SparkSession, name: str, checkpoints: str, every: str = EVERY
) -> StreamingQuery:
    """A query under a ``LateGuard``, which is its attribute ``guard``."""
    guard = LateGuard(spark, name)
    spark.streams.addListener(guard)
    try:
        query = launch(writer, name, checkpoints, every=every)
    except BaseException:
        spark.streams.removeListener(guard)
        raise
    query.guard = guard
    return query


def project_job(
    messages: DataFrame, path: str, name: str, checkpoints: str, **run
) -> StreamingQuery:
    """Two columns of every pick, as lines of JSON."""
    picks = json_table(messages, PICK_TABLE)
    printed = project(picks, *PRINT_SINK.fieldNames())
    return launch(lines_writer(printed, path), name, checkpoints, **run)


def copy_job(
    messages: DataFrame,
    writer_of: Callable[[DataFrame, StructType], DataStreamWriter],
    name: str,
    checkpoints: str,
    **run,
) -> StreamingQuery:
    """Ride messages to another topic, strict on missing fields.

    No shuffle: a partition of the source keeps its order.
    """
    rides = json_table(messages, RIDE_TABLE, message_schema=RIDE_MESSAGE, strict=True)
    writer = writer_of(rides, RIDE_SINK).outputMode("append")
    return launch(writer, name, checkpoints, **run)


def arrival_writer(rows: DataFrame, schema: StructType, journal: Journal) -> DataStreamWriter:
    """Rows by position into a table that also holds in which order they came."""

    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        arrived = with_arrival(batch, batch_id)
        journal.add(batch.sparkSession, batch_id, lambda path: arrived.write.parquet(path))

    return each_batch(insert_positional(rows, schema), write)


def tail_job(
    records: DataFrame, path: str, name: str, checkpoints: str, **run
) -> StreamingQuery:
    """Every field of every record of a topic, as lines of JSON."""
    return launch(lines_writer(raw_records(records), path), name, checkpoints, **run)
