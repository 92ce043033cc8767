"""Column expressions shared by every operator."""

from tallystream.functions.messages import parse_messages, parse_picks, quarantine
from tallystream.functions.encoding import json_text, stats_json, to_messages
from tallystream.functions.picks import (
    GATE_CURRENCY,
    LOSS,
    PUSH,
    USER_KEY_PREFIX,
    WON,
    gated,
    outcome,
    trailing_id,
    user_key,
)

__all__ = [
    "GATE_CURRENCY",
    "LOSS",
    "PUSH",
    "USER_KEY_PREFIX",
    "WON",
    "gated",
    "json_text",
    "outcome",
    "parse_messages",
    "parse_picks",
    "quarantine",
    "stats_json",
    "to_messages",
    "trailing_id",
    "user_key",
]
