"""Topics, JSON tables and stored state."""

from tallystream.sources.stored import read_touched
from tallystream.sources.tables import json_table
from tallystream.sources.topics import (
    file_topic,
    kafka_options,
    kafka_values,
    raw_records,
    start_options,
)

__all__ = [
    "file_topic",
    "json_table",
    "kafka_options",
    "kafka_values",
    "raw_records",
    "read_touched",
    "start_options",
]
