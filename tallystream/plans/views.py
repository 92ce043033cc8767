"""Picks, rides and messages taken from the ``events`` table."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallystream.functions.encoding import json_text
from tallystream.functions.picks import user_key
from tallystream.sources.topics import MAX_FILE_AGE


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(
    spark: SparkSession, sf_dir: str, max_bytes_per_trigger: int = 200 << 30
) -> DataFrame:
    """The same table as a stream. The pattern matches a file and a folder alike."""
    schema = events(spark, sf_dir).schema
    return files_stream(spark, f"{sf_dir}/events.parque[t]", schema, max_bytes_per_trigger)


def files_stream(
    spark: SparkSession, path: str, schema: StructType, max_bytes_per_trigger: int = 200 << 30
) -> DataFrame:
    """Parquet files as a stream, of any age."""
    return (
        spark.readStream.schema(schema)
        .option("maxBytesPerTrigger", max_bytes_per_trigger)
        .option("maxFileAge", MAX_FILE_AGE)
        .parquet(path)
    )


def picks(rows: DataFrame, *keep: str) -> DataFrame:
    """Events as picks: the columns the pick queries use, the event time, and ``keep``."""
    kind = F.col("event_type")
    state = (
        F.when(kind == "purchase", 511)
        .when(kind == "click", 512)
        .when(kind == "view", 513)
        .otherwise(501)
    )
    return rows.select(
        user_key(F.col("user_id")).alias("user_fkey"),
        F.lit(82).alias("type"),
        F.when(F.col("event_id") % 4 == 0, 331).otherwise(333).alias("currency_code"),
        F.round(F.col("value") * 100).cast("int").alias("risk_amount"),
        state.alias("settlement_state"),
        "ts",
        *keep,
    )


def _millis(ts: Column) -> Column:
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, ts)


def _pick_text() -> Column:
    return json_text(
        _millis(F.col("ts")).alias("created_stamp_millis_utc"),
        "currency_code",
        "risk_amount",
        "settlement_state",
        "type",
        "user_fkey",
    )


def pick_messages(rows: DataFrame) -> DataFrame:
    """Events as topic records: ``key``, ``value`` (JSON text), ``ts``."""
    return picks(rows).select(F.col("user_fkey").alias("key"), _pick_text().alias("value"), "ts")


def pick_records(rows: DataFrame) -> DataFrame:
    """Events as pick messages with their place in a topic."""
    return picks(rows, "user_id", "event_id").select(
        F.col("user_fkey").alias("key"),
        _pick_text().alias("value"),
        F.lit("picks").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def flawed_messages(rows: DataFrame) -> DataFrame:
    """Pick messages with a fault per event type, to count what each policy does.

    purchase: whole; click: no risk_amount; view: risk_amount null;
    error: text cut short; any other: risk_amount as text.
    """
    user = F.concat(F.lit('{"user_fkey":"'), user_key(F.col("user_id")), F.lit('"'))
    kind = F.col("event_type")
    rest = (
        F.when(kind == "purchase", F.lit(',"risk_amount":5}'))
        .when(kind == "click", F.lit("}"))
        .when(kind == "view", F.lit(',"risk_amount":null}'))
        .when(kind == "error", F.lit(',"risk_amount":5'))
        .otherwise(F.lit(',"risk_amount":"5"}'))
    )
    return rows.select("event_type", F.concat(user, rest).alias("value"))


def rides(rows: DataFrame) -> DataFrame:
    """Events as rides."""
    return rows.select(
        F.col("event_id").alias("rideId"),
        F.col("user_id").alias("taxiId"),
        (F.col("event_type") == "signup").alias("isStart"),
        F.col("value").cast("float").alias("lon"),
        (-F.col("value")).cast("float").alias("lat"),
        (F.col("user_id") % 5).cast("int").alias("psgCnt"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("eventTime"),
    )


def raw_topic(rows: DataFrame) -> DataFrame:
    """Events as whole topic records, key and value in bytes."""
    return rows.select(
        user_key(F.col("user_id")).cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("picks").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
