"""Topic sources.

The Kafka connector is Spark's own package and must be on the class path. All
operators and jobs take the DataFrame these functions return, so any frame
with a text column ``value`` stands in for a topic: files, a rate source, a
table.
"""

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.schemas import RAW_RECORD


def start_options(start: str | datetime | dict[str, dict[str, int]] = "latest") -> dict[str, str]:
    """Where a *new* query starts. Later runs continue from their checkpoint.

    ``latest`` and ``earliest`` are the ends of the topic. ``resume`` is what a
    consumer group with an earliest fallback does: continue from the last run,
    else start at the earliest record. Spark keeps that position in the
    checkpoint, not in the broker.

    A time with a zone starts each partition at its first record of that time or later,
    or at its end if there is none. A dictionary of topics and partitions gives the
    offset of each, as ``PositionedLedger.starting_offsets`` does.
    """
    if isinstance(start, datetime):
        if start.tzinfo is None:
            raise ValueError("a start by time needs a time zone")
        return {
            "startingTimestamp": str(round(start.timestamp() * 1000)),
            "startingOffsetsByTimestampStrategy": "latest",
        }
    if isinstance(start, dict):
        return {"startingOffsets": json.dumps(start, sort_keys=True)}
    positions = {"latest": "latest", "earliest": "earliest", "resume": "earliest"}
    if start not in positions:
        raise ValueError(f"start must be one of {sorted(positions)}, not {start!r}")
    return {"startingOffsets": positions[start]}


def kafka_options(
    servers: str,
    topic: str,
    start: str | datetime | dict[str, dict[str, int]] = "latest",
    max_offsets_per_trigger: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Reader options. Offsets that are gone fail the query instead of being skipped."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "failOnDataLoss": "true",
        **start_options(start),
        **extra,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_records(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The topic as a stream of whole records."""
    return spark.readStream.format("kafka").options(**options).load()


def kafka_values(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The topic as a stream of texts, one column ``value``."""
    return kafka_records(spark, options).select(F.col("value").cast("string").alias("value"))


def raw_records(records: DataFrame) -> DataFrame:
    """Every field of each record, key and value as text."""
    columns = [F.col(name) for name in RAW_RECORD.fieldNames()]
    if "headers" in records.columns:
        columns.append(F.col("headers"))
    return (
        records.select(*columns)
        .withColumn("key", F.col("key").cast("string"))
        .withColumn("value", F.col("value").cast("string"))
    )


# No file is too old to be read: a topic may be filled late, or from copies with their
# times kept. The source then remembers all files it has read, in the driver's memory.
MAX_FILE_AGE = "36500d"


def file_topic(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Text files, one message per line, as a stream of column ``value``."""
    reader = spark.readStream.option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.text(path)
