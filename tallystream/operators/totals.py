"""Running totals per user."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.functions.picks import LOSS, PUSH, WON, gated, outcome, trailing_id

TOTALS = ["total_picks", "total_coins_staked", "won", "loss", "push"]


def contributions(picks: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """What each pick adds to its user's totals, one row per pick.

    Narrow: no shuffle, and the scan reads four columns. A pick in another
    currency gives a row of zeros, so that its user still gets totals. ``keep``
    names columns to carry along.
    """
    currency, state = F.col("currency_code"), F.col("settlement_state")
    no_stake = F.raise_error(F.lit("no risk_amount in a pick that counts")).cast("int")
    stake = F.coalesce(F.col("risk_amount"), no_stake)
    user_id = (
        F.col("user_id") if "user_id" in picks.columns else trailing_id(F.col("user_fkey"))
    )
    return picks.select(
        user_id.alias("user_id"),
        gated(F.lit(1), currency).alias("total_picks"),
        gated(stake, currency).alias("total_risk_amount"),
        outcome(state, WON, currency).alias("won"),
        outcome(state, LOSS, currency).alias("loss"),
        outcome(state, PUSH, currency).alias("push"),
        *keep,
    )


def user_totals(contributed: DataFrame) -> DataFrame:
    """A1: totals per user.

    Partial aggregation leaves at most one row per user and map task, so a
    user with a large part of all picks costs the shuffle no more than others.
    """
    return contributed.groupBy("user_id").agg(
        F.sum("total_picks").alias("total_picks"),
        F.sum("total_risk_amount").alias("total_coins_staked"),
        F.sum("won").alias("won"),
        F.sum("loss").alias("loss"),
        F.sum("push").alias("push"),
    )


def add_totals(rows: DataFrame) -> DataFrame:
    """Add up rows that already are totals; a null counts as 0."""
    return rows.groupBy("user_id").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in TOTALS)
    )


def merge_totals(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """A2: stored totals plus new totals, for users of either side.

    A union and one aggregation do the work of a full outer join with one
    shuffle of pre-aggregated rows, no sort, and any number of rows per user.
    """
    columns = ["user_id", *TOTALS]
    return add_totals(stored.select(*columns).unionByName(delta.select(*columns)))
