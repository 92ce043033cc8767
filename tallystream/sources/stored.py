"""Stored per-user state in a relational table."""

from pyspark.sql import DataFrame, SparkSession


def read_touched(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    staging: str,
    attempt: str,
    bounds: tuple[int, int],
    partitions: int = 16,
) -> DataFrame:
    """Stored maps of the users staged under ``attempt``, read in parallel.

    The restriction to those users runs in the database, where the staged rows
    are: Spark does not push join keys into a JDBC scan, and reading the whole
    table for each batch would cost as much as the table is long. ``bounds``
    only set the stride of the partitions; they drop no row.
    """
    query = (
        f"(SELECT t.user_id, CAST(t.general_stats AS varchar) AS general_stats "
        f"FROM {table} t WHERE t.user_id IN "
        f"(SELECT s.user_id FROM {staging} s WHERE s.attempt_id = '{attempt}')) touched"
    )
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", query)
        .option("partitionColumn", "user_id")
        .option("lowerBound", bounds[0])
        .option("upperBound", max(bounds[1], bounds[0] + 1))
        .option("numPartitions", partitions)
        .load()
    )
