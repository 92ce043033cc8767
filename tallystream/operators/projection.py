"""Column projection (R1) and positional insert (R2)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def project(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns; the scan reads no others."""
    return df.select(*columns)


def insert_positional(df: DataFrame, sink: StructType) -> DataFrame:
    """R2: the first column goes to the sink's first column, and so on.

    Names do not matter; the number of columns must agree. Values are cast to
    the sink's types.
    """
    if len(df.columns) != len(sink.fields):
        raise ValueError(
            f"the sink has {len(sink.fields)} columns, the query {len(df.columns)}"
        )
    renamed = df.toDF(*sink.fieldNames())
    return renamed.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in sink.fields)
    )
