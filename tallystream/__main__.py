"""Runs one of the jobs: ``spark-submit`` this file, or ``python -m tallystream``.

    totals    running totals per user, added to a stored table
    counters  the totals as one JSON counter map per user, merged into a table
    windows   stake per user in tumbling processing-time windows
    print     two columns of each pick, as lines of JSON
    copy      ride messages to another topic, strict on missing fields
    tail      every field of each record, as lines of JSON
    publish   rows of a parquet table as keyed JSON messages, once

Messages come from a Kafka topic (``--servers``, ``--topic``) or from text files
(``--files``). Results go to a database (``--jdbc-url``, ``--table``), to a topic
(``--to-topic``) or to files (``--to-files``). Database user and password are
read from the variables DB_USER and DB_PASSWORD.
"""

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from tallystream.functions.encoding import to_messages
from tallystream.operators.totals import TOTALS
from tallystream.schemas import RAW_RECORD
from tallystream.sources.topics import (
    MAX_FILE_AGE,
    file_topic,
    kafka_options,
    kafka_records,
    kafka_values,
)
from tallystream.streaming import jobs
from tallystream.streaming.jdbc import counters_target, totals_target, windows_target
from tallystream.streaming.ledger import Ledger
from tallystream.streaming.processing_time import await_guarded, closing_windows, closing_windows_sql
from tallystream.streaming.sinks import (
    file_topic_writer,
    kafka_batch_write,
    kafka_writer,
    kafka_writer_options,
    table_writer,
)

# Default start of each job: totals build on what is stored and take new
# messages only, the others read the whole topic.
START = {"totals": "latest", "counters": "latest"}


def options() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(
        "tallystream", description=__doc__, formatter_class=argparse.RawTextHelpFormatter
    )
    parser.add_argument(
        "job", choices=["totals", "counters", "windows", "print", "copy", "tail", "publish"]
    )
    parser.add_argument("--servers", help="Kafka servers")
    parser.add_argument("--topic", help="topic to read")
    parser.add_argument("--start", choices=["latest", "earliest", "resume"])
    parser.add_argument("--files", help="folder of messages, or of the table to publish")
    parser.add_argument("--to-topic")
    parser.add_argument("--to-files")
    parser.add_argument("--jdbc-url", help="jdbc:postgresql://host:port/database")
    parser.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    parser.add_argument("--table", help="table to write to")
    parser.add_argument("--name", help="name of the query, default the job")
    parser.add_argument("--checkpoints", help="folder shared by all executors")
    parser.add_argument("--max-offsets", type=int, help="messages of a batch from a topic, at most")
    parser.add_argument("--max-bytes", type=int, help="bytes of a batch from files, about")
    parser.add_argument("--every", help="trigger interval")
    parser.add_argument("--window", default="30 seconds")
    parser.add_argument("--sql", action="store_true", help="windows by SQL")
    parser.add_argument("--key", help="key column of published messages")
    parser.add_argument("--once", action="store_true", help="process what is there and end")
    return parser


def messages(spark: SparkSession, args) -> DataFrame:
    if args.files:
        return file_topic(spark, args.files, max_bytes_per_trigger=args.max_bytes)
    return kafka_values(spark, _topic(args))


def records(spark: SparkSession, args) -> DataFrame:
    if args.files:
        reader = spark.readStream.schema(RAW_RECORD).option("maxFileAge", MAX_FILE_AGE)
        if args.max_bytes:
            reader = reader.option("maxBytesPerTrigger", args.max_bytes)
        return reader.parquet(args.files)
    return kafka_records(spark, _topic(args))


def _topic(args) -> dict[str, str]:
    start = args.start or START.get(args.job, "earliest")
    return kafka_options(args.servers, args.topic, start, args.max_offsets)


def database(args, make):
    """The sink of a batch in the database, with a PostgreSQL client's connection."""

    def connect():
        import psycopg2

        return psycopg2.connect(
            args.jdbc_url.removeprefix("jdbc:"),
            user=os.environ["DB_USER"],
            password=os.environ["DB_PASSWORD"],
        )

    jdbc = {
        "url": args.jdbc_url,
        "driver": args.jdbc_driver,
        "user": os.environ["DB_USER"],
        "password": os.environ["DB_PASSWORD"],
    }
    return make(jdbc, connect, args.table).write


def start(spark: SparkSession, args):
    """The running query of a streaming job."""
    name = args.name or args.job
    if not args.checkpoints:
        raise SystemExit("--checkpoints is needed: without it a restart would count again or skip")
    if args.files and args.start:
        raise SystemExit("--start is for topics: files are read from the first, once each")
    if args.job in ("print", "tail") and not args.to_files:
        raise SystemExit(f"{args.job} needs --to-files")
    checkpoints = args.checkpoints
    run = {"available_now": args.once}
    if args.every:
        run["every"] = args.every

    if args.job == "totals":
        ledger = Ledger(args.to_files, ["user_id"], TOTALS) if args.to_files else None
        write = ledger.add if ledger else database(args, totals_target)
        return jobs.totals_job(messages(spark, args), write, name, checkpoints, **run)
    if args.job == "counters":
        ledger = Ledger(args.to_files, ["user_id", "key"], ["total"]) if args.to_files else None
        write = ledger.add if ledger else database(args, counters_target)
        return jobs.counters_job(messages(spark, args), write, name, checkpoints, **run)
    if args.job == "windows":
        if args.once:
            raise SystemExit("windows close with the clock: --once does not apply")
        form = closing_windows_sql if args.sql else closing_windows

        def writer(df):
            if args.to_topic:
                return kafka_writer(df, kafka_writer_options(args.servers, args.to_topic))
            if args.to_files:
                return table_writer(df, args.to_files)
            return jobs.each_batch(df, database(args, windows_target))

        return jobs.window_job(
            messages(spark, args),
            writer,
            name,
            checkpoints,
            every=args.every or "1 second",
            windows=lambda picks: form(picks, size=args.window),
        )
    if args.job == "print":
        return jobs.project_job(messages(spark, args), args.to_files, name, checkpoints, **run)
    if args.job == "tail":
        return jobs.tail_job(records(spark, args), args.to_files, name, checkpoints, **run)

    def copy_writer(df, schema):
        if args.to_files:
            return file_topic_writer(df, args.to_files, schema)
        return kafka_writer(df, kafka_writer_options(args.servers, args.to_topic), schema)

    return jobs.copy_job(messages(spark, args), copy_writer, name, checkpoints, **run)


def main(argv: list[str] | None = None) -> None:
    args = options().parse_args(argv)
    spark = SparkSession.builder.appName(f"tallystream {args.job}").getOrCreate()
    if args.job == "publish":
        table = spark.read.parquet(args.files)
        if args.to_files:
            if args.key:
                to_messages(table, key=args.key).write.parquet(args.to_files)
            else:
                to_messages(table).write.text(args.to_files)
        else:
            kafka_batch_write(table, kafka_writer_options(args.servers, args.to_topic), args.key)
        return
    await_guarded(start(spark, args))


if __name__ == "__main__":
    main()
