"""Stream writers without a name, checkpoint or trigger; ``launch`` adds those.

Kafka writers need Spark's own Kafka package. The file writers are exactly-once
through Spark's file sink log, and stand in for a topic or a table.
"""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tallystream.functions.encoding import to_messages
from tallystream.operators.projection import insert_positional


def lines_writer(df: DataFrame, path: str) -> DataStreamWriter:
    """K6: every row as a line of JSON, written by the task that has it; nulls included.

    Times are written to the microsecond, Spark's own precision.
    """
    moment = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
    return (
        df.writeStream.format("json")
        .option("path", path)
        .option("ignoreNullFields", "false")
        .option("timestampNTZFormat", moment)
        .option("timestampFormat", f"{moment}[XXX]")
    )


def preview_writer(df: DataFrame, rows: int = 20) -> DataStreamWriter:
    """The first rows of each batch to the console, to look at; the others are not shown."""
    return df.writeStream.format("console").option("truncate", "false").option("numRows", rows)


def kafka_writer_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **extra}


def kafka_writer(
    df: DataFrame,
    options: dict[str, str],
    schema: StructType | None = None,
    key: str | None = None,
) -> DataStreamWriter:
    """K4, K5: rows as JSON messages to a topic, by position if ``schema`` is given.

    The broker places messages by key, so messages of one key keep their order.
    """
    rows = df if schema is None else insert_positional(df, schema)
    return to_messages(rows, key).writeStream.format("kafka").options(**options)


def kafka_batch_write(
    df: DataFrame, options: dict[str, str], key: str | None = None
) -> None:
    """K8: publish a batch of rows as JSON messages."""
    to_messages(df, key).write.format("kafka").options(**options).save()


def file_topic_writer(
    df: DataFrame, path: str, schema: StructType | None = None, compression: str = "none"
) -> DataStreamWriter:
    """JSON messages to text files, one per line."""
    rows = df if schema is None else insert_positional(df, schema)
    writer = to_messages(rows).writeStream.format("text").option("compression", compression)
    return writer.option("path", path)


def table_writer(df: DataFrame, path: str) -> DataStreamWriter:
    """K3 on files: closed windows appended to a parquet table."""
    return df.writeStream.format("parquet").option("path", path).outputMode("append")
