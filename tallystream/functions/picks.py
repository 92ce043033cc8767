"""Rules that turn a pick into counters."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The currency whose picks count, the three settled outcomes,
# and the prefix of a user key.
GATE_CURRENCY = 333
WON = 511
LOSS = 512
PUSH = 513
USER_KEY_PREFIX = "fobj__sb_user_profile__"


def trailing_id(key: Column) -> Column:
    """the integer after the last ``__`` of a composite key.

    A key without a valid trailing integer is a bad record and fails the
    query, whatever the session's ANSI setting. ``try_cast`` follows ANSI
    rules, so ``5.5`` and out-of-range numbers are bad as well.

    Keys are split from the left. Only where three underscores meet does that
    differ from a search from the right, which is faster.
    """
    split = F.element_at(F.split(key, "__"), -1)
    tail = F.when(F.contains(key, F.lit("___")), split).otherwise(
        F.substring_index(key, "__", -1)
    )
    message = F.concat(F.lit("no user id in key: "), F.coalesce(key, F.lit("null")))
    return F.coalesce(tail.try_cast("bigint"), F.raise_error(message).cast("bigint"))


def user_key(user_id: Column) -> Column:
    """rebuild the composite key of a user id."""
    return F.concat(F.lit(USER_KEY_PREFIX), user_id.cast("string"))


def gated(amount: Column, currency: Column) -> Column:
    """``amount`` for the gate currency, else 0.

    Other currencies, and a null code, give a zero row; they are not filtered.
    """
    return F.when(currency == GATE_CURRENCY, amount).otherwise(F.lit(0))


def outcome(state: Column, code: int, currency: Column) -> Column:
    """1 if a gated pick settled with ``code``, else 0."""
    return gated(F.when(state == code, 1).otherwise(0), currency)
