"""The registered queries: (session, folder of tables) -> DataFrame.

Streaming queries run to the end of the table and return what their sink holds.
They write below the shared folder of ``scratch_dir``.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallystream.functions import (
    parse_picks,
    json_text,
    quarantine,
    stats_json,
    to_messages,
    trailing_id,
)
from tallystream.operators import (
    contributions,
    counters_to_json,
    explode_counters,
    insert_defaults,
    insert_positional,
    lookup_stored,
    merge_counters,
    merge_totals,
    project,
    steps_back,
    sum_counters,
    tumble,
    tumble_sql,
    user_totals,
)
from tallystream.operators.totals import TOTALS
from tallystream.plans import views
from tallystream.schemas import (
    PICK_TABLE,
    PRINT_SINK,
    RIDE_MESSAGE,
    RIDE_SINK,
    RIDE_TABLE,
)
from tallystream.sources import file_topic, json_table, raw_records
from tallystream.streaming import file_topic_writer, launch, scratch_dir, table_writer
from tallystream.streaming.jobs import (
    arrival_writer,
    copy_job,
    project_job,
    counters_writer,
    each_batch,
    launch_guarded,
    positioned_totals_job,
    tail_job,
    totals_as_counters,
    totals_job,
    totals_writer,
)
from tallystream.streaming.journal import EventWindows, Journal, split_batch
from tallystream.streaming.ledger import Ledger
from tallystream.streaming.positions import PositionedLedger
from tallystream.streaming.processing_time import (
    closing_windows,
    closing_windows_sql,
    wait_closed,
)
from tallystream.streaming.slices import SliceTable, put_parquet
from tallystream.streaming.snapshot import Snapshot

CUT = "2024-01-16 00:00:00"
EARLY_CUT = "2024-01-02 00:00:00"
TOPIC_PARTITIONS = 16
ORDERED_ROWS = 20_000_000
STORED_MAPS = StructType().add("user_id", "long").add("general_stats", "string")


def _before(moment: str) -> Column:
    return F.col("ts") < F.lit(moment).cast("timestamp_ntz")


def _in_two_runs(
    spark: SparkSession, sf_dir: str, work: str, run: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Publish the events before a cut and run a query over them, then the later ones.

    ``run`` starts the query over the stream of events, each time under the same name and
    checkpoint, so that the second run goes on where the first one ended.
    """
    rows = views.events(spark, sf_dir)
    for part in (rows.where(_before(CUT)), rows.where(~_before(CUT))):
        part.write.mode("append").parquet(f"{work}/events")
        run(views.files_stream(spark, f"{work}/events", rows.schema)).awaitTermination()


def _picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.picks(views.events(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.pick_messages(views.events(spark, sf_dir))


# --- messages and projections ------------------------------------------------


def pick_parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, F2 (record profile), F3, F12."""
    return parse_picks(_messages(spark, sf_dir))


def pick_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lenient JSON table, read by name; missing fields are null."""
    json_table(_messages(spark, sf_dir), PICK_TABLE, name="pick_table")
    return spark.table("pick_table")


def pick_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1."""
    return project(_picks(spark, sf_dir), *PRINT_SINK.fieldNames())


def pick_project_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9, R2: insert by position into a named table."""
    path = scratch_dir(spark, "picks_printed")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.catalog.createTable(name, path=path, source="parquet", schema=PRINT_SINK)
    try:
        pick_project(spark, sf_dir).write.insertInto(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # its files are external and stay
    return spark.read.schema(PRINT_SINK).parquet(path)


def ride_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict parse, reorder by name, insert by position."""
    rides = views.rides(views.events(spark, sf_dir))
    messages = to_messages(rides.select(*RIDE_MESSAGE.fieldNames()))
    table = json_table(messages, RIDE_TABLE, message_schema=RIDE_MESSAGE, strict=True)
    return insert_positional(table, RIDE_SINK)


def print_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of every message, written as they come."""
    messages = views.pick_messages(views.events_stream(spark, sf_dir)).select("value")
    work = scratch_dir(spark, "print")
    project_job(
        messages, f"{work}/printed", "print", f"{work}/checkpoints", available_now=True
    ).awaitTermination()
    return spark.read.schema(PRINT_SINK).json(f"{work}/printed")


def ride_copy_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream from messages to messages."""
    rides = views.rides(views.events_stream(spark, sf_dir))
    messages = to_messages(rides.select(*RIDE_MESSAGE.fieldNames()))
    work = scratch_dir(spark, "ride_copy")
    copy_job(
        messages,
        lambda df, sink: file_topic_writer(df, f"{work}/topic", sink, compression="gzip"),
        "ride_copy",
        f"{work}/checkpoints",
        available_now=True,
    ).awaitTermination()
    return json_table(spark.read.text(f"{work}/topic"), RIDE_SINK, strict=True)


def ride_copy_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides published in order, copied over several runs of the query, and
    per taxi how often a ride came after a later one.

    A publication has one file a partition of the topic, which one task reads, and at most
    about ``ORDERED_ROWS`` rows, so that a partition that most rides are in stays small;
    larger tables are published, and copied, in more runs. Sequences are ride ids.
    """
    work = scratch_dir(spark, "ride_order")
    journal = Journal(f"{work}/table")
    rides = views.rides(views.events(spark, sf_dir)).withColumn(
        "partition", F.pmod(F.hash("taxiId"), F.lit(TOPIC_PARTITIONS))
    )
    ends = rides.agg(F.count("*").alias("n"), F.min("rideId").alias("a"), F.max("rideId").alias("b")).first()
    runs = max(2, -(-ends["n"] // ORDERED_ROWS))
    first, width = ends["a"] or 0, -(-((ends["b"] or 0) - (ends["a"] or 0) + 1) // runs)
    for run in range(runs):
        low = first + run * width
        part = rides.where(F.col("rideId").between(low, low + width - 1))
        ordered = part.repartition(TOPIC_PARTITIONS, "partition").sortWithinPartitions("partition", "rideId")
        message = json_text(*RIDE_MESSAGE.fieldNames()).alias("value")
        messages = ordered.select(message, "partition")
        messages.write.mode("append").partitionBy("partition").text(f"{work}/topic", compression="gzip")
        copy_job(
            file_topic(spark, f"{work}/topic/*", max_bytes_per_trigger=1 << 60),
            lambda rows, schema: arrival_writer(rows, schema, journal),
            "ride_order",
            f"{work}/checkpoints",
            available_now=True,
        ).awaitTermination()
    return steps_back(spark.read.parquet(*journal.folders(spark)), "taxiId", "rideId")


def publish_keyed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8, F12."""
    return to_messages(pick_project(spark, sf_dir), key="user_fkey")


def strict_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """messages that pass and fail under the lenient and the strict policy."""
    parsed = quarantine(
        views.flawed_messages(views.events(spark, sf_dir)),
        PRINT_SINK,
        required=PRINT_SINK.fieldNames(),
        reason="reason",
        keep=["event_type"],
    )
    malformed = F.coalesce(F.col("reason") == "malformed", F.lit(False))
    return parsed.groupBy("event_type").agg(
        F.count_if(~malformed).alias("lenient_good"),
        F.count_if(malformed).alias("lenient_bad"),
        F.count_if(F.col("reason").isNull()).alias("strict_good"),
        F.count_if(F.col("reason").isNotNull()).alias("strict_bad"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5."""
    return raw_records(views.raw_topic(views.events(spark, sf_dir)))


# --- totals ------------------------------------------------------------------


def pick_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3, F5-F7, R4, U1, U2."""
    return _picks(spark, sf_dir).transform(contributions)


def user_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1."""
    return _picks(spark, sf_dir).transform(contributions).transform(user_totals)


def user_stats_zero_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users who only bet in another currency get a row of zeros."""
    currency = F.when(trailing_id(F.col("user_fkey")) % 4 == 0, 331).otherwise(333)
    picks = _picks(spark, sf_dir).withColumn("currency_code", currency)
    return picks.transform(contributions).transform(user_totals)


def user_stats_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: totals before a cut merged with totals after it."""
    picks = _picks(spark, sf_dir)
    before = user_totals(contributions(picks.where(_before(CUT))))
    after = user_totals(contributions(picks.where(~_before(CUT))))
    return merge_totals(before, after)


def user_stats_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8."""
    columns = ("won", "loss", "push", "total_coins_staked", "total_picks")
    text = stats_json(*map(F.col, columns))
    return user_stats(spark, sf_dir).select("user_id", text.alias("general_stats"))


def user_stats_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateful totals in update mode; the last value of a user is kept, over
    two runs of the query."""
    session = _stream_session(spark)
    work = scratch_dir(spark, "user_stats")
    snapshot = Snapshot(f"{work}/table", ["user_id"], user_stats(spark, sf_dir).schema)

    def run(rows: DataFrame) -> StreamingQuery:
        totals = user_totals(contributions(views.picks(rows)))
        writer = each_batch(totals, snapshot.put).outputMode("update")
        return launch(writer, "user_stats", f"{work}/checkpoints", available_now=True)

    _in_two_runs(session, sf_dir, work, run)
    return snapshot.read(spark)


def user_stats_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch's totals added to the stored totals, over two runs of the query."""
    work = scratch_dir(spark, "user_stats_upsert")
    ledger = _totals_ledger(f"{work}/table")

    def run(rows: DataFrame) -> StreamingQuery:
        writer = totals_writer(contributions(views.picks(rows)), ledger.add)
        return launch(writer, "user_stats_upsert", f"{work}/checkpoints", available_now=True)

    _in_two_runs(spark, sf_dir, work, run)
    return ledger.read(spark)


def user_stats_from_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish picks as messages, add them up, publish the
    later ones, and go on from the checkpoint in a second run."""
    work = scratch_dir(spark, "user_stats_from_topic")
    rows = views.events(spark, sf_dir)
    ledger = _totals_ledger(f"{work}/table")
    for part in (rows.where(_before(CUT)), rows.where(~_before(CUT))):
        published = views.pick_messages(part).select("value")
        published.write.mode("append").option("maxRecordsPerFile", 1_000_000).text(
            f"{work}/topic", compression="gzip"
        )
        messages = file_topic(spark, f"{work}/topic", max_bytes_per_trigger=50 << 30)
        totals_job(
            messages, ledger.add, "user_stats_from_topic", f"{work}/checkpoints", available_now=True
        ).awaitTermination()
    return ledger.read(spark)


def user_stats_lost_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add up the first records of a topic, lose the checkpoint, publish the
    others, and go on under a new checkpoint that reads the topic from its start.

    Each run reads all files in one batch: files, unlike a topic, are in no order.
    """
    work = scratch_dir(spark, "lost_checkpoint")
    records = views.pick_records(views.events(spark, sf_dir))
    ends = records.agg(F.min("offset").alias("first"), F.max("offset").alias("last")).first()
    first = F.col("offset") <= F.lit(((ends["first"] or 0) + (ends["last"] or 0)) // 2)
    ledger = PositionedLedger(f"{work}/table", keys=["user_id"], sums=TOTALS)
    for run, part in enumerate((records.where(first), records.where(~first))):
        part.write.mode("append").parquet(f"{work}/topic")
        topic = views.files_stream(spark, f"{work}/topic", records.schema, 1 << 60)
        positioned_totals_job(
            topic, ledger, "lost_checkpoint", f"{work}/checkpoints-{run}", available_now=True
        ).awaitTermination()
    return ledger.read(spark)


def _totals_ledger(path: str, **settings) -> Ledger:
    return Ledger(path, keys=["user_id"], sums=TOTALS, **settings)


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session whose streams keep their state in RocksDB, off the heap."""
    session = spark.newSession()
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(name, spark.conf.get(name))
    return session


# --- counter maps ------------------------------------------------------------


def _counters(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", F.col("props").alias("general_stats"))


def _split(spark: SparkSession, sf_dir: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """Counter maps per event after the cut, and the stored maps from before it."""
    rows = views.events(spark, sf_dir)
    before = _counters(rows.where(_before(cut)))
    after = _counters(rows.where(~_before(cut)))
    return after, counters_to_json(sum_counters(explode_counters(before)))


def counter_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5."""
    return explode_counters(_counters(views.events(spark, sf_dir)))


def counter_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5, A3, F9."""
    return sum_counters(counter_unnest(spark, sf_dir))


def counter_cte(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates of a sub-query's aggregates."""
    return (
        counter_sum(spark, sf_dir)
        .groupBy("user_id")
        .agg(F.count("*").alias("keys"), F.sum("total").alias("total"))
    )


def general_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4."""
    return counters_to_json(counter_sum(spark, sf_dir))


def counter_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag union of stored and new maps, one map per user on each side."""
    after, stored = _split(spark, sf_dir, CUT)
    fresh = counters_to_json(sum_counters(explode_counters(after)))
    return stored.unionByName(fresh)


def stored_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New maps with the stored map of the user, or null."""
    after, stored = _split(spark, sf_dir, EARLY_CUT)
    fresh = counters_to_json(sum_counters(explode_counters(after)))
    return lookup_stored(fresh, stored)


def general_stats_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6, R7, R8, S7, A5."""
    after, stored = _split(spark, sf_dir, CUT)
    return merge_counters(after, stored)


def stored_lookup_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New maps with the stored map of the user, of which only the buckets that
    hold such users are read."""
    after, stored = _split(spark, sf_dir, EARLY_CUT)
    fresh = counters_to_json(sum_counters(explode_counters(after)))
    table = Snapshot(f"{scratch_dir(spark, 'stored_maps')}/table", ["user_id"], STORED_MAPS)
    table.put(stored, "stored", 0)
    return lookup_stored(fresh, table.read(spark, touched_by=after))


def general_stats_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter maps of each batch merged into the stored maps, over two runs."""
    work = scratch_dir(spark, "general_stats_upsert")
    ledger = Ledger(f"{work}/table", keys=["user_id", "key"], sums=["total"])

    def run(rows: DataFrame) -> StreamingQuery:
        writer = counters_writer(_counters(rows), ledger.add)
        return launch(writer, "general_stats_upsert", f"{work}/checkpoints", available_now=True)

    _in_two_runs(spark, sf_dir, work, run)
    return counters_to_json(ledger.read(spark, together="user_id"), together=True)


def user_stats_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals as counter maps, with the columns of a first insert."""
    return _user_stats_table(spark, sf_dir).drop("created", "updated")


def _user_stats_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of users with the time of their first insert, over two runs."""
    work = scratch_dir(spark, "user_stats_table")
    ledger = Ledger(
        f"{work}/table", keys=["user_id", "key"], sums=["total"], firsts=["created"]
    )

    def add(batch: DataFrame, query_id: str, batch_id: int) -> None:
        entries = totals_as_counters(batch).withColumn("created", F.current_timestamp())
        ledger.add(entries, query_id, batch_id)

    def run(rows: DataFrame) -> StreamingQuery:
        writer = each_batch(contributions(views.picks(rows)), add)
        return launch(writer, "user_stats_table", f"{work}/checkpoints", available_now=True)

    _in_two_runs(spark, sf_dir, work, run)
    rows = ledger.read(spark, together="user_id")
    stored = counters_to_json(rows, F.min("created").alias("created"), together=True)
    return insert_defaults(stored, F.col("created"))


# --- windows -----------------------------------------------------------------


def _tumble_sql(size: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A6, R3."""
        _picks(spark, sf_dir).createOrReplaceTempView("picks_data")
        return tumble_sql(spark, "picks_data", on="ts", size=size)

    return query


def _tumble_fluent(size: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A7."""
        return tumble(_picks(spark, sf_dir), on="ts", size=size)

    return query


def tumble_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window sums as JSON messages, read back as a table."""
    sums = tumble(_picks(spark, sf_dir), on="ts")
    return json_table(to_messages(sums), sums.schema, strict=True)


def tumble_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 over a stream in any order: window sums of each batch, added by the sink, over
    two runs.

    No watermark, so no row can be late, and no state that grows with the table.
    """
    work = scratch_dir(spark, "tumble")
    keys = ["user_fkey", "window_start", "window_end"]
    ledger = Ledger(f"{work}/table", keys=keys, sums=["total_risk_amount"])

    def run(rows: DataFrame) -> StreamingQuery:
        picks = views.picks(rows).select("user_fkey", "risk_amount", "ts")
        writer = each_batch(
            picks, lambda df, q, n: ledger.add(tumble(df, on="ts", exact=True), q, n)
        )
        return launch(writer, "tumble", f"{work}/checkpoints", available_now=True)

    _in_two_runs(spark, sf_dir, work, run)
    return ledger.read(spark)


def tumble_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the picks' own time under a watermark, and the rows too late for it.

    The picks after the cut come first, so that most of the others are late. Closed
    windows with what late rows would add to them, and the number of these rows.
    """
    work = scratch_dir(spark, "event_time")
    windows = EventWindows(f"{work}/table", "user_fkey", "risk_amount", "ts", "1 day", "1 hour")
    rows = views.events(spark, sf_dir)
    for part in (rows.where(~_before(CUT)), rows.where(_before(CUT))):
        part.write.mode("append").parquet(f"{work}/events")
        picks = views.picks(views.files_stream(spark, f"{work}/events", rows.schema))
        writer = each_batch(picks.select("user_fkey", "risk_amount", "ts"), windows.write)
        launch(writer, "event_time", f"{work}/checkpoints", available_now=True).awaitTermination()
    picked = views.picks(rows)
    late = windows.late(spark, picked.select("user_fkey", "risk_amount", "ts").schema)
    late = late.groupBy("user_fkey", F.window("ts", "1 hour").alias("w")).agg(
        F.sum("risk_amount").alias("total"), F.count("*").alias("late")
    )
    late = late.select(
        "user_fkey", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total", "late"
    )
    sums = tumble(picked, on="ts", size="1 hour", exact=True).withColumnRenamed(
        "total_risk_amount", "total"
    )
    found = windows.closed(spark, sums.withColumn("rows", F.lit(1).cast("long")).schema)
    return (
        found.withColumn("late", F.lit(0).cast("long"))
        .unionByName(late.withColumn("rows", F.lit(0).cast("long")))
        .groupBy("user_fkey", "window_start", "window_end")
        .agg(
            F.sum("total").alias("total_risk_amount"),
            F.sum("rows").alias("in_time"),
            F.sum("late").alias("late"),
        )
    )


def tail_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of every record of a stream, as lines of JSON, in two runs."""
    work = scratch_dir(spark, "tail")

    def run(rows: DataFrame) -> StreamingQuery:
        records = views.raw_topic(rows)
        return tail_job(records, f"{work}/lines", "tail", f"{work}/checkpoints", available_now=True)

    _in_two_runs(spark, sf_dir, work, run)
    return spark.read.schema(raw(spark, sf_dir).schema).json(f"{work}/lines")


def quarantine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """messages into a table of good and one of bad, both parts of one commit a batch."""
    work = scratch_dir(spark, "quarantine")
    journal = Journal(f"{work}/table")

    def judge(batch: DataFrame) -> DataFrame:
        parsed = quarantine(batch, PRINT_SINK, required=PRINT_SINK.fieldNames(), reason="reason")
        return parsed.withColumn("part", F.when(F.col("reason").isNull(), "good").otherwise("bad"))

    def run(rows: DataFrame) -> StreamingQuery:
        messages = views.flawed_messages(rows).select("value")
        writer = each_batch(messages, split_batch(journal, judge, "part"))
        return launch(writer, "quarantine", f"{work}/checkpoints", available_now=True)

    _in_two_runs(spark, sf_dir, work, run)
    none = spark.createDataFrame([], "value string")
    schema = judge(none).drop("part").schema
    parts = [
        journal.read(spark, name, schema).withColumn("part", F.lit(name)) for name in ("good", "bad")
    ]
    return parts[0].unionByName(parts[1])


def flush_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of every pick in slices of 1,000 rows, in two runs. Every third
    slice of a task is refused once; ``all_repeated`` tells if each of these was repeated,
    and no other."""
    work = scratch_dir(spark, "flush")

    def refuse_some(files, path: str, rows, trial: int) -> None:
        number = int(path.rsplit("-", 1)[1].removesuffix(".parquet"))
        if number % 3 == 0 and trial == 0:
            raise OSError("refused once")
        put_parquet(files, path, rows, trial)

    table = SliceTable(f"{work}/table", refuse_some, rows=1000, seconds=60, pause=0.01)

    def run(rows: DataFrame) -> StreamingQuery:
        printed = project(views.picks(rows), *PRINT_SINK.fieldNames())
        writer = each_batch(printed, table.write)
        return launch(writer, "flush", f"{work}/checkpoints", available_now=True)

    _in_two_runs(spark, sf_dir, work, run)
    repeated = all(task["retries"] == -(-task["slices"] // 3) for task in table.tasks(spark))
    return table.read(spark, PRINT_SINK).withColumn("all_repeated", F.lit(repeated))


def windows_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows as JSON messages in a topic of files, read back as a
    table; summed per user."""
    work = scratch_dir(spark, "window_messages")
    session = _stream_session(spark)
    picks = views.picks(views.events_stream(session, sf_dir))
    closed = closing_windows(picks, size="2 seconds", exact=True)
    stream = launch_guarded(
        file_topic_writer(closed, f"{work}/topic"), session, "window_messages", f"{work}/checkpoints", "1 second"
    )
    wait_closed(stream, size_seconds=2)
    stored = json_table(spark.read.text(f"{work}/topic"), closed.schema, strict=True)
    return stored.groupBy("user_fkey").agg(
        F.sum("total_risk_amount").alias("total_risk_amount")
    )


def _windows_append(windows):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Processing-time windows, written once on close; summed per user.

        Windows of two seconds keep the wait short.
        """
        work = scratch_dir(spark, "windows")
        session = _stream_session(spark)
        picks = views.picks(views.events_stream(session, sf_dir))
        writer = table_writer(windows(picks, size="2 seconds", exact=True), f"{work}/table")
        stream = launch_guarded(writer, session, "windows", f"{work}/checkpoints", "1 second")
        wait_closed(stream, size_seconds=2)
        stored = spark.read.parquet(f"{work}/table")
        return stored.groupBy("user_fkey").agg(
            F.sum("total_risk_amount").alias("total_risk_amount")
        )

    return query


QUERIES = {
    "pick_parse_json": pick_parse_json,
    "pick_table": pick_table,
    "pick_project": pick_project,
    "pick_project_insert": pick_project_insert,
    "print_stream": print_stream,
    "pick_contributions": pick_contributions,
    "user_stats": user_stats,
    "user_stats_zero_rows": user_stats_zero_rows,
    "user_stats_merge": user_stats_merge,
    "user_stats_stream": user_stats_stream,
    "user_stats_upsert": user_stats_upsert,
    "user_stats_from_topic": user_stats_from_topic,
    "user_stats_lost_checkpoint": user_stats_lost_checkpoint,
    "user_stats_json": user_stats_json,
    "counter_unnest": counter_unnest,
    "counter_union": counter_union,
    "counter_sum": counter_sum,
    "counter_cte": counter_cte,
    "general_stats": general_stats,
    "stored_lookup": stored_lookup,
    "stored_lookup_buckets": stored_lookup_buckets,
    "general_stats_merge": general_stats_merge,
    "general_stats_upsert": general_stats_upsert,
    "user_stats_table_upsert": user_stats_table_upsert,
    "tumble_sql": _tumble_sql("30 seconds"),
    "tumble_fluent": _tumble_fluent("30 seconds"),
    "tumble_sql_hour": _tumble_sql("1 hour"),
    "tumble_fluent_day": _tumble_fluent("1 day"),
    "tumble_messages": tumble_messages,
    "tumble_stream": tumble_stream,
    "tumble_event_time": tumble_event_time,
    "flush_stream": flush_stream,
    "windows_append": _windows_append(closing_windows),
    "windows_append_sql": _windows_append(closing_windows_sql),
    "windows_messages": windows_messages,
    "ride_copy": ride_copy,
    "ride_copy_stream": ride_copy_stream,
    "ride_copy_order": ride_copy_order,
    "publish_keyed_json": publish_keyed_json,
    "strict_missing": strict_missing,
    "quarantine_stream": quarantine_stream,
    "raw_records": raw,
    "tail_stream": tail_stream,
}
