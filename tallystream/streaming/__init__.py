"""Structured Streaming: processing-time windows, sinks and named jobs."""

from tallystream.streaming.jobs import (
    copy_job,
    counters_job,
    launch,
    project_job,
    scratch_dir,
    tail_job,
    totals_job,
    window_job,
)
from tallystream.streaming.journal import EventWindows, Journal
from tallystream.streaming.ledger import Ledger
from tallystream.streaming.positions import PositionedLedger
from tallystream.streaming.processing_time import (
    LateGuard,
    await_guarded,
    closing_windows,
    closing_windows_sql,
    heartbeat,
    wait_closed,
)
from tallystream.streaming.slices import SliceTable
from tallystream.streaming.snapshot import Snapshot
from tallystream.streaming.sinks import (
    lines_writer,
    preview_writer,
    file_topic_writer,
    kafka_batch_write,
    kafka_writer,
    kafka_writer_options,
    table_writer,
)

__all__ = [
    "EventWindows",
    "Journal",
    "LateGuard",
    "Ledger",
    "PositionedLedger",
    "SliceTable",
    "Snapshot",
    "await_guarded",
    "closing_windows",
    "closing_windows_sql",
    "lines_writer",
    "preview_writer",
    "copy_job",
    "counters_job",
    "file_topic_writer",
    "heartbeat",
    "kafka_batch_write",
    "kafka_writer",
    "kafka_writer_options",
    "launch",
    "project_job",
    "scratch_dir",
    "table_writer",
    "tail_job",
    "totals_job",
    "wait_closed",
    "window_job",
]
