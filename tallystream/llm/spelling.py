"""Spelling variants: words one edit apart, by dense tiles of code points.

Words are the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts with A-Z lower-cased,
counted over all documents. A seeded rule on id and run may delete one code point first
(``DELETE_EVERY``), which plants misspellings at a known rate.

Two words are near if one inserted, deleted or replaced code point separates them: then
their common prefix and common suffix together reach the longer length minus one. To find
all such pairs without comparing all words, each length is cut into segments of two code
points. An edit falls into one segment, and the words agree on all before and after it.
Each word is therefore sent, for each segment of its own length and of the next one, to
the block of words that agree with it outside the segment. Up to ``SHORT`` code points a
block differs in two code points at most, so it has at most 90^2 + 90 words, whatever the
corpus. Longer words have ``SHORT / 2`` wider segments, and blocks that were counted to be
larger than that bound are split into pairs of parts. Within a task, blocks lie one behind
the other in padded matrices of code points; tiles of them are compared pair by pair, and
a pair that shares several blocks is taken in the first one.

A word's form is its most frequent near word if that is ``RATIO`` times as frequent; forms
are followed to the root by pointer doubling, with as many rounds as the greatest count
allows, since each step multiplies the count by ``RATIO``.

Null texts have no words, a null doc_id is written as nothing in the rule; an empty table
gives no rows. Among near words of one count the smallest in code-point order is the form.
Very long texts are read in pieces cut at white space. Of docs only doc_id and text are
read; other columns may have any name.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.llm.texts import pieces, raw_text, shared_checkpoints, slices, split_groups

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
DELETE_EVERY = 31
SHORT = 64
BLOCK_WORDS = 90**2 + 90
TILE = 64
FLUSH = 200_000  # distinct words a task holds before it hands on their counts

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _counter(min_length: int, delete_every: int):
    run = re.compile(f"[a-z\\u00C0-\\u00FF]{{{min_length},}}")

    def flushed(counts: Counter) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
            ["word", "n"],
        )
        counts.clear()
        return batch

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                for doc_id, raw in zip(part.column("doc_id").to_pylist(), part.column("raw")):
                    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for piece in pieces(raw.as_py().translate(_LOWER)):
                        found = Counter(run.findall(piece.decode("utf-8", "replace")))
                        for word, n in found.items():
                            h = zlib.crc32(word.encode(), seed)
                            if h % delete_every == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < min_length:
                                    continue
                            counts[word] += n
                        if len(counts) > FLUSH:
                            yield flushed(counts)
        yield flushed(counts)

    return count


def word_counts(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    delete_every: int = DELETE_EVERY,
) -> DataFrame:
    """Rows (word, n) of the words long and frequent enough."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text())
    counted = rows.mapInArrow(_counter(min_length, delete_every), "word string, n long")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _blocks(words: DataFrame) -> DataFrame:
    """Words once for each block: (block, longer, start, word, n, side).

    ``longer`` is the length of the longer word of a pair, ``start`` where the segment
    begins, ``side`` 0 or 1 in a block that compares two parts of a split one, else -1.
    """
    length = F.char_length("word")
    longer = F.explode(F.array(length, length + 1)).alias("longer")
    width = F.when(F.col("longer") <= SHORT, 2).otherwise(
        F.ceil(F.col("longer") / (SHORT // 2)).cast("int")
    )
    starts = F.sequence(F.lit(0), F.col("longer") - 1, width)
    rows = words.select("word", "n", longer).select(
        "*", F.explode(starts).alias("start"), width.alias("width")
    )
    tail = F.greatest(F.col("longer") - F.col("start") - F.col("width"), F.lit(0))
    block = F.xxhash64(
        "longer",
        "start",
        F.substring("word", F.lit(1), F.col("start")),
        F.substring("word", length - tail + 1, tail),
    )
    rows = rows.select(block.alias("block"), "longer", "start", "word", "n")
    short, long = rows.filter(F.col("longer") <= SHORT), rows.filter(F.col("longer") > SHORT)
    long = split_groups(long, "word", F.lit(1), BLOCK_WORDS)
    return short.withColumn("side", F.lit(-1)).unionByName(long)


def _matrices(codes: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Code points of words, one a row, padded with zeros behind, and turned round likewise."""
    width = int(lengths.max()) + 1  # a last column in which no two words agree
    flat = np.frombuffer(b"".join(codes), np.uint8)
    row = np.repeat(np.arange(len(codes)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ahead = np.zeros((len(codes), width), np.uint8)
    back = np.zeros_like(ahead)
    ahead[row, place] = flat
    back[row, np.repeat(lengths, lengths) - 1 - place] = flat
    return ahead, back


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row of a and each row of b."""
    return ((a[:, None, :] != b[None, :, :]) | (a[:, None, :] == 0)).argmax(axis=2)


def near_pairs(
    block: np.ndarray, longer: np.ndarray, start: np.ndarray, side: np.ndarray, words: list[str]
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one block that are one edit apart; rows are sorted by block.

    A pair is given in the first of its segments only.
    """
    codes = [w.encode("latin-1") for w in words]
    lengths = np.array([len(c) for c in codes], np.int64)
    ahead, back = _matrices(codes, lengths)
    left, right = [], []
    for at in range(0, len(block), TILE):
        a = slice(at, at + TILE)
        for to in range(at, len(block), TILE):
            if to > at and block[to] != block[a][-1]:
                break
            b = slice(to, to + TILE)
            same = block[a][:, None] == block[b][None, :]
            same &= (side[a] < 0)[:, None] | (side[a][:, None] != side[b][None, :])
            if to == at:
                same = np.triu(same, 1)
            if not same.any():
                continue
            prefix, suffix = _agree(ahead[a], ahead[b]), _agree(back[a], back[b])
            long = np.maximum(lengths[a][:, None], lengths[b][None, :])
            short = np.minimum(lengths[a][:, None], lengths[b][None, :])
            # Equal words agree on all, which is one more than a single edit leaves at most.
            near = same & (prefix + suffix >= long - 1) & (long - short <= 1)
            near &= (prefix < long) & (long == longer[a][:, None])
            first = start[a][:, None]
            near &= (first == 0) | (suffix < long - first)
            i, j = np.nonzero(near)
            left.append(i + at)
            right.append(j + to)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions (word, near, near_n) of the near pairs of rows sorted by block."""

    def pairs(table: pa.Table) -> pa.RecordBatch:
        block = table.column("block").to_numpy()
        again = np.empty(len(block), bool)
        again[:1] = False
        again[1:] = block[1:] == block[:-1]
        shared = again.copy()
        shared[:-1] |= again[1:]
        table = table.filter(pa.array(shared))
        if not table.num_rows:
            i = j = np.empty(0, np.int64)
        else:
            i, j = near_pairs(
                *(table.column(c).to_numpy() for c in ("block", "longer", "start", "side")),
                table.column("word").to_pylist(),
            )
        word, n = table.column("word"), table.column("n")
        one, other = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
        columns = [word.take(one), word.take(other), n.take(other)]
        return pa.table(columns, names=["word", "near", "near_n"]).combine_chunks()

    kept: list[pa.RecordBatch] = []
    for batch in batches:
        block = batch.column("block").to_numpy()
        if not len(block):
            continue
        # All but the last block are whole; that one may go on in the next batch.
        cut = _last_start(block)
        if cut:
            done = pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = []
            yield from pairs(done).to_batches()
        kept.append(batch.slice(cut))
    if kept:
        yield from pairs(pa.Table.from_batches(kept)).to_batches()


def _last_start(block: np.ndarray) -> int:
    """Where the last run of equal blocks begins."""
    changes = np.flatnonzero(block[1:] != block[:-1])
    return int(changes[-1]) + 1 if len(changes) else 0


def near_words(words: DataFrame) -> DataFrame:
    """Rows (word, near, near_n): all pairs of words (word, n) one edit apart, both ways."""
    rows = _blocks(words).repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(_compare, "word string, near string, near_n long")


def _roots(forms: DataFrame, rounds: int) -> DataFrame:
    """Rows (word, root): forms (word, form) followed to the last by pointer doubling."""
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        roots = roots.checkpoint()
        after = roots.select(F.col("word").alias("at"), F.col("root").alias("next"))
        roots = roots.join(after, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root")
        )
    return roots


def spelling_variants(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    delete_every: int = DELETE_EVERY,
) -> DataFrame:
    """Per word: word, form, root, n, n_near and form_n."""
    shared_checkpoints(docs.sparkSession)
    words = word_counts(docs, min_length, min_count, delete_every).checkpoint()
    near = near_words(words).groupBy(F.col("word").alias("of"))
    best = near.agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"),
    )
    enough = -F.col("best.less") >= ratio * F.col("n")
    found = words.join(best, F.col("word") == F.col("of"), "left").select(
        "word",
        F.when(enough, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    found = found.checkpoint()
    forms = found.filter("form IS NOT NULL")
    # Counts grow by the ratio with each step, so this many steps reach every root.
    most, steps = found.agg(F.max("n")).first()[0] or 0, 1
    while min_count * ratio ** (steps + 1) <= most:
        steps += 1
    roots = _roots(forms, math.ceil(math.log2(steps))).select(F.col("word").alias("of"), "root")
    return found.join(roots, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
