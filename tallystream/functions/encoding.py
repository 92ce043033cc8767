"""Rows to JSON text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark leaves null fields out by default; a message states every field. Times
# are written in UTC, whatever the session's zone.
_OPTIONS = {"ignoreNullFields": "false", "timeZone": "UTC"}


def json_text(*columns: str | Column) -> Column:
    """one JSON object of the columns, in the order given."""
    return F.to_json(F.struct(*columns), _OPTIONS)


def stats_json(
    won: Column, loss: Column, push: Column, staked: Column, picks: Column
) -> Column:
    """F8: totals as one JSON object, under the names of the counter map."""
    return json_text(
        won.alias("won"),
        loss.alias("loss"),
        push.alias("push"),
        staked.alias("total_coins_staked"),
        picks.alias("total_settled_picks"),
    )


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """K8: rows as messages, ``key`` (text, optional) and ``value`` (JSON)."""
    value = json_text(*df.columns).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)
