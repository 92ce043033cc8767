"""DataFrame -> DataFrame operators."""

from tallystream.operators.counters import (
    counters_to_json,
    explode_counters,
    insert_defaults,
    lookup_stored,
    merge_counters,
    sum_counters,
    touched_only,
)
from tallystream.operators.order import steps_back, with_arrival
from tallystream.operators.projection import insert_positional, project
from tallystream.operators.totals import contributions, merge_totals, user_totals
from tallystream.operators.windows import tumble, tumble_sql, with_proctime

__all__ = [
    "contributions",
    "counters_to_json",
    "explode_counters",
    "insert_defaults",
    "insert_positional",
    "lookup_stored",
    "merge_counters",
    "merge_totals",
    "project",
    "steps_back",
    "sum_counters",
    "touched_only",
    "tumble",
    "tumble_sql",
    "user_totals",
    "with_arrival",
    "with_proctime",
]
