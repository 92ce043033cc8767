"""Tumbling stake sums per user.

Windows are half-open and aligned to the epoch. All currencies count here.
Sums are exact ``bigint``; the ``float`` of the published column is taken from
the final sum.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW_SIZE = "30 seconds"


def with_proctime(df: DataFrame) -> DataFrame:
    """the time at which a row is processed; one value per micro-batch."""
    return df.withColumn("proctime", F.current_timestamp())


def tumble(
    df: DataFrame, on: str = "proctime", size: str = WINDOW_SIZE, exact: bool = False
) -> DataFrame:
    """Stake per window and user. ``exact`` keeps the bigint sum."""
    total = F.sum("risk_amount")
    return (
        df.groupBy(F.window(on, size).alias("w"), "user_fkey")
        .agg((total if exact else total.cast("float")).alias("total_risk_amount"))
        .select(
            "user_fkey",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "total_risk_amount",
        )
    )


def tumble_sql(
    spark: SparkSession, table: str, on: str = "proctime", size: str = WINDOW_SIZE
) -> DataFrame:
    """The same in SQL (R3), over a registered table or stream."""
    return spark.sql(
        f"""
        SELECT user_fkey,
               window.start AS window_start,
               window.end AS window_end,
               CAST(sum(risk_amount) AS FLOAT) AS total_risk_amount
        FROM {table}
        GROUP BY window({on}, '{size}'), user_fkey
        """
    )
