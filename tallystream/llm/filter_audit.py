"""What each of several filters removes in every order, by contractions of a contingency tensor.

Five filters are judged on whole texts; words are maximal ``[^\\x20\\x09-\\x0D]+``:

    A  under 200 words
    B  100 * distinct words < 50 * words
    C  100 * characters A-Z > 2 * code points
    D  holds any of ``#$%&*|``
    E  identical to the text of a smaller doc_id anywhere in the table

One pass over the texts gives a row of id, part, failed filters and digest per document,
and repeats of such a row are added up before anything is shuffled by id. E is a join on
digest and id, so copies do not meet in one task. Rows are then counted by part and by the
32 combinations of failures: at most 32 counts a part, however many documents it has.
A part's counts, reshaped to 2x2x2x2x2 (pass, fail along each axis), answer every question
about an order of filters: contract each axis with (1, 0) for filters applied before,
(0, 1) or (1, 0) for the one applied now, and (1, 1) for those that come later.

Null texts are empty (no words: A fails), a null part is the part ''. A document without
id has no smaller id and no label, so it passes E; rows that repeat the smallest id of a
text pass E as well. An id with several labels counts as good if one of them says
quality 1, as toxic if one says toxic 1. Very long texts are counted in pieces cut at
white space. An empty table gives no rows. Of docs only doc_id, source and text are read,
of labels doc_id, quality and toxic; other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.llm.texts import pieces, raw_text, shared_checkpoints, slices

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 2
MEASURES = ("n", "good", "toxic")
OUTPUT = (
    "part", "filter_order", "step",
    "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
)
PARTS_AT_ONCE = 64

_NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
_CONTINUATION = bytes(range(0x80, 0xC0))
_NOT_SYMBOL = bytes(c for c in range(256) if c not in b"#$%&*|")

PASS, FAIL, ALL = (np.array(v, np.int64) for v in ((1, 0), (0, 1), (1, 1)))


def text_failures(raw: bytes) -> int:
    """Filters A to D that UTF-8 text fails, as bits 0 to 3."""
    n, distinct = 0, set()
    for piece in pieces(raw):
        found = piece.split()
        n += len(found)
        distinct.update(found)
    points = len(raw.translate(None, _CONTINUATION))
    upper = len(raw.translate(None, _NOT_UPPER))
    return (
        (n < MIN_WORDS)
        | (100 * len(distinct) < MIN_DISTINCT_PERCENT * n) << 1
        | (100 * upper > MAX_UPPER_PERCENT * points) << 2
        | bool(raw.translate(None, _NOT_SYMBOL)) << 3
    )


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            raws = [value.as_py() for value in part.column("raw")]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("part"),
                    pa.array([text_failures(r) for r in raws], pa.int32()),
                    pa.array([hashlib.sha256(r).digest()[:16] for r in raws], pa.binary()),
                ],
                ["doc_id", "part", "fails", "digest"],
            )


def failures(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, part, digest, fails, n): equal rows counted, failed filters as bits."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        raw_text(),
    ).mapInArrow(_judge, "doc_id long, part string, fails int, digest binary")
    rows = rows.groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n"))
    rows = rows.checkpoint()
    first = rows.groupBy(F.col("digest").alias("of")).agg(F.min("doc_id").alias("first"))
    on = (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("first"))
    copy = F.col("of").isNull() & F.col("doc_id").isNotNull()
    return rows.join(first, on, "left").select(
        "doc_id", "part", "digest", (F.col("fails") + F.when(copy, 16).otherwise(0)).alias("fails"), "n"
    )


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with 0/1 columns good and toxic. Rows without id are spread by their digest."""
    marks = labels.filter("doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("of"), F.lit(0).cast("long").alias("spread_of")
    ).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest").bitwiseOR(F.lit(1)))
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(0))).withColumn(
        "spread", F.coalesce(spread, F.lit(0))
    )
    on = (F.col("id") == F.col("of")) & (F.col("spread") == F.col("spread_of"))
    return rows.join(marks, on, "left").select(
        "part", "fails", "n", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic"))
    )


@cache
def _steps(filters: str) -> list[tuple[str, int, str]]:
    orders = ("".join(order) for order in permutations(filters))
    return [(order, k + 1, order[:k]) for order in orders for k in range(len(filters))]


def contract(tensor: np.ndarray, filters: str, axes: dict[str, np.ndarray]) -> np.ndarray:
    """Sums (parts, measures) of a tensor (parts, 2, ..., 2, measures); axes not named: all."""
    last = len(filters) + 1
    operands = [tensor, list(range(last + 1))]
    for k, letter in enumerate(filters):
        operands += [axes.get(letter, ALL), [k + 1]]
    return np.einsum(*operands, [0, last])


def audit_rows(tensor: np.ndarray, filters: str) -> dict[str, np.ndarray]:
    """The audit's counts, each (parts, orders * steps), from a tensor (parts, 2, ..., 2, 3)."""

    @cache
    def removed(before: frozenset, letter: str) -> np.ndarray:
        return contract(tensor, filters, {**dict.fromkeys(before, PASS), letter: FAIL})

    @cache
    def kept(passed: frozenset) -> np.ndarray:
        return contract(tensor, filters, dict.fromkeys(passed, PASS))[:, 0]

    fails = {x: contract(tensor, filters, {x: FAIL})[:, 0] for x in filters}
    others = {x: frozenset(filters) - {x} for x in filters}
    columns = {c: [] for c in OUTPUT[3:]}
    shapley = {x: np.zeros(len(tensor), np.int64) for x in filters}
    for order, step, before in _steps(filters):
        shapley[order[step - 1]] += removed(frozenset(before), order[step - 1])[:, 0]
    for order, step, before in _steps(filters):
        letter = order[step - 1]
        here = removed(frozenset(before), letter)
        columns["kept"].append(kept(frozenset(order[:step])))
        columns["removed"].append(here[:, 0])
        columns["redundant"].append(fails[letter] - here[:, 0])
        columns["unique_fails"].append(removed(others[letter], letter)[:, 0])
        columns["good_lost"].append(here[:, 1])
        columns["toxic_lost"].append(here[:, 2])
        columns["shapley"].append(shapley[letter])
    return {c: np.stack(values, axis=1) for c, values in columns.items()}


def _contract_parts(filters: str):
    steps = _steps(filters)
    orders, numbers = [s[0] for s in steps], [s[1] for s in steps]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS_AT_ONCE):
                some = batch.slice(at, PARTS_AT_ONCE)
                parts = some.column("part").to_pylist()
                tensor = np.zeros((len(parts), 1 << len(filters), len(MEASURES)), np.int64)
                for k, cells in enumerate(some.column("cells").to_pylist()):
                    for cell in cells:
                        tensor[k, cell["fails"]] = [cell[m] for m in MEASURES]
                # Bit 0 is the first filter, but the last axis of a reshape varies fastest.
                tensor = tensor.reshape(len(parts), *(2,) * len(filters), len(MEASURES))
                turned = (0, *range(len(filters), 0, -1), len(filters) + 1)
                counts = audit_rows(tensor.transpose(turned), filters)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array(parts, object), len(steps)), pa.string()),
                        pa.array(orders * len(parts), pa.string()),
                        pa.array(numbers * len(parts), pa.int32()),
                        *(pa.array(values.ravel()) for values in counts.values()),
                    ],
                    list(OUTPUT),
                )

    return run


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The audit of rows (part, fails, n, good, toxic): bit k of ``fails`` is the k-th filter,
    n the number of documents, good and toxic 0 or 1."""
    cells = rows.groupBy("part", "fails").agg(
        F.sum("n").alias("n"), *(F.sum(F.col(c) * F.col("n")).alias(c) for c in MEASURES[1:])
    )
    cell = F.struct("fails", *MEASURES)
    # At most 2^filters cells a part.
    parts = cells.groupBy("part").agg(F.collect_list(cell).alias("cells"))
    counts = ", ".join(f"{c} long" for c in OUTPUT[3:])
    return parts.mapInArrow(
        _contract_parts(filters), f"part string, filter_order string, step int, {counts}"
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the five filters and step: the counts named in ``OUTPUT``."""
    shared_checkpoints(docs.sparkSession)
    return audit(_labelled(failures(docs), labels))
