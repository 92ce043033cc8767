"""Proof that a copy keeps the order of each key."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BATCH, PLACE = "arrival_batch", "arrival_place"
# A key's rows are compared in blocks of at most 2**20 places, so that no task has to
# sort all rows of a key that most rows have.
BLOCK_BITS = 20


def with_arrival(df: DataFrame, batch_id: int) -> DataFrame:
    """Rows with the batch and the place in it at which a sink gets them.

    The place rises with the task and with the row in a task. It says in which order rows
    of one task came; a source partition is read by one task a batch.
    """
    return df.select(
        "*", F.lit(batch_id).cast("long").alias(BATCH), F.monotonically_increasing_id().alias(PLACE)
    )


def steps_back(arrived: DataFrame, key: str, sequence: str) -> DataFrame:
    """Per key: rows, ``steps_back``, and the first and the last sequence to arrive.

    A step back is a row whose sequence is less than that of the row of its key that came
    before it. None means that the key's order was kept, repeated rows allowed. Rows
    without a sequence are counted and passed over; rows without a key are one key.

    Steps inside a block are counted there. Steps between blocks need the first and the
    last sequence of each, one row per key and block.
    """
    number = F.col("sequence")
    rows = arrived.select(
        F.col(key).alias("key"),
        F.col(sequence).alias("sequence"),
        F.col(BATCH).alias("batch"),
        F.shiftright(PLACE, BLOCK_BITS).alias("block"),
        F.col(PLACE).alias("place"),
    )
    inside = Window.partitionBy("key", "batch", "block").orderBy("place")
    known = F.when(number.isNotNull(), F.col("place"))
    blocks = (
        rows.withColumn("back", number < _before("sequence", inside))
        .groupBy("key", "batch", "block")
        .agg(
            F.count("*").alias("rows"),
            F.count_if("back").alias("back"),
            F.min_by("sequence", known).alias("first"),
            F.max_by("sequence", known).alias("last"),
        )
    )
    across = Window.partitionBy("key").orderBy("batch", "block")
    at = F.when(F.col("first").isNotNull(), F.struct("batch", "block"))
    return (
        blocks.withColumn("between", F.col("first") < _before("last", across))
        .groupBy("key")
        .agg(
            F.sum("rows").alias("rows"),
            (F.sum("back") + F.count_if("between")).alias("steps_back"),
            F.min_by("first", at).alias("first_seen"),
            F.max_by("last", at).alias("last_seen"),
        )
        .withColumnRenamed("key", key)
    )


def _before(column: str, window):
    """The nearest value before a row that is not null."""
    return F.last(column, ignorenulls=True).over(
        window.rowsBetween(Window.unboundedPreceding, -1)
    )
