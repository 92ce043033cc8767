"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths give, per text, the characters inside
n-grams found more than once, inside the most frequent short n-gram, and inside
repeated lines.

Null and empty texts have no words; they fail the base rule. Repeated rows each
get their own row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.llm.texts import mix, raw_text, slices

_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rules:
    """Limits are shares of a text's word characters, or of its words for symbols.

    ``top``: for an n-gram length, the share of the most frequent n-gram's
    occurrences; ``inside``: the share of n-grams found twice or more, first
    ones included; ``lines``: of lines equal to an earlier one.
    """

    min_words: int = 20
    window: int = 8
    window_percent: int = 30
    top: dict[int, float] = field(default_factory=lambda: {2: 0.25, 3: 0.25, 4: 0.25})
    inside: dict[int, float] = field(default_factory=lambda: {5: 0.4, 10: 0.4})
    lines: float = 0.35
    symbols: float = 0.25


def rolling(ids: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """Hashes of all windows of each length: sum of hash(word) * base^(n-1-k).

    The window of n words follows from that of n-1: h_n[i] = h_{n-1}[i] * base + w[i+n-1].
    """
    values, found = mix(ids.astype(np.uint64) + np.uint64(1)), {}
    h = values
    for n in range(1, min(max(lengths), len(ids)) + 1):
        if n > 1:
            h = h[:-1] * _BASE + values[n - 1 :]
        if n in lengths:
            found[n] = h
    return found


def repeats(ids: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of windows found twice or more, and their group.

    Windows of one hash are compared word by word with the first of them; unequal
    ones (a collision) are told apart by sorting the windows themselves.
    """
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    group = np.cumsum(new) - 1
    many = np.bincount(group)[group] > 1
    if not many.any():
        return order[:0], group[:0]
    starts, first, group = order[many], order[new][group[many]], group[many]
    offsets = np.arange(n)
    for at in range(0, len(starts), 1 << 16):
        part = slice(at, at + (1 << 16))
        if (ids[starts[part, None] + offsets] != ids[first[part, None] + offsets]).any():
            _, group, count = np.unique(
                ids[starts[:, None] + offsets], axis=0, return_inverse=True, return_counts=True
            )
            return starts[count[group] > 1], group[count[group] > 1]
    return starts, group


def covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in one of the windows."""
    edges = np.zeros(total + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + n, -1)
    return np.cumsum(edges[:-1]) > 0


def judge(raw: bytes, rules: Rules) -> tuple:
    """All measures of one text and its verdict."""
    tokens = raw.split()  # at bytes 0x20 and 0x09 to 0x0D
    n_words = len(tokens)
    solid = np.frombuffer(b"".join(tokens), np.uint8)
    word_chars = int(np.count_nonzero((solid & 0xC0) != 0x80))
    n_symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    seen: set[bytes] = set()
    line_chars = n_dup_lines = 0
    for line in lines:
        if line in seen:
            n_dup_lines += 1
            line_chars += len(b"".join(line.split()).decode("utf-8", "replace"))
        seen.add(line)

    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(t, len(index)) for t in tokens), np.int64, n_words)
    sizes = np.fromiter((len(t.decode("utf-8", "replace")) for t in index), np.int64, len(index))
    chars = sizes[ids] if n_words else ids
    total = max(word_chars, 1)

    lengths = sorted({rules.window, *rules.top, *rules.inside})
    hashes = rolling(ids, lengths) if n_words else {}
    n_repeat_words, top, inside, over, none_longer = 0, 0.0, 0.0, False, False
    for n in lengths:
        if n not in hashes or none_longer:
            continue
        starts, group = repeats(ids, hashes[n], n)
        none_longer = not len(starts)  # a longer window repeats only if its parts do
        if none_longer:
            continue
        if n == rules.window or n in rules.inside:
            hit = covered(starts, n, n_words)
            if n == rules.window:
                n_repeat_words = int(hit.sum())
            if n in rules.inside:
                share = float(chars[hit].sum()) / total
                inside, over = max(inside, share), over or share > rules.inside[n]
        if n in rules.top:
            counts = np.bincount(group)
            best = starts[group == counts.argmax()]
            share = float(chars[covered(best, n, n_words)].sum()) / total
            top, over = max(top, share), over or share > rules.top[n]

    base_failed = n_words < rules.min_words or (
        100 * n_repeat_words > rules.window_percent * n_words
    )
    kept = not (
        base_failed
        or over
        or line_chars > rules.lines * total
        or n_symbols > rules.symbols * n_words
    )
    return (
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
        top, inside, line_chars / total,
    )


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, top_share double, inside_share double, line_share double"
)


def repetition_rules(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """One row per document: doc_id, the measures and the verdict."""
    rules = rules or Rules()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                columns = list(zip(*(judge(x, rules) for x in part.column("raw").to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, columns)],
                    ["doc_id", *(x.split()[0] for x in MEASURES.split(", "))],
                )

    source = docs.select(F.col("doc_id").cast("long"), raw_text())
    return source.mapInArrow(run, f"doc_id long, {MEASURES}")


def keep_by_rules(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """The documents that pass, with their columns; judged and filtered in one go."""
    rules, schema = rules or Rules(), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                kept = [judge(x or b"", rules)[6] for x in texts]
                yield part.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, schema)
