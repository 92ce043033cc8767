"""Benchmark decontamination by a generalised suffix automaton.

The words of all test items form one automaton. A text's words are streamed
through it; the state tells the longest stretch that ends at a word and occurs in
an item. A stretch of ``window`` words, or a whole shorter item, is a hit.

Items are cut into pieces and dealt into shards of a bounded number of words, so
that each automaton is of bounded size however many items there are. A shard's
automaton is built in a task and stored in the shared folder. Tasks over documents
read one shard after the other, so neither they nor the driver hold all of them.

Null and empty texts have no words and no hits; null and empty items no windows.
Repeated items count once by item_id, null ids as ``null``. Repeated documents
each get a row. Very long texts are streamed whole, one at a time. Empty tables give no
rows, and no hits. Only doc_id, text, item_id and item text are read; ``decontaminate``
keeps all columns, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from tallystream.llm.texts import new_names, raw_text, slices, stored, words
from tallystream.streaming.slices import place

WINDOW = 10
SHARD_WORDS = 200_000
# Bytes of texts that pass through all shards before the next ones do.
BLOCK = 32 << 20

# Columns of a document while it passes through the shards.
TEXT, SPANS, ITEMS = "__raw", "__spans", "__items"


class Automaton:
    """Generalised suffix automaton of word sequences, for one shard of items.

    States' transitions are in one dictionary keyed by state * vocabulary + word.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.size = max(1, len(self.vocabulary))
        self.next: dict[int, int] = {}
        self.length, self.link, self.edges = [0], [-1], [[]]
        coded = [(name, [self.vocabulary[w] for w in ws]) for name, ws in items if ws]
        for _, ids in coded:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        del self.edges
        self.least = min((min(len(ids), window) for _, ids in coded), default=0)
        # Items by the state that holds their window; whole short items by their state.
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for name, ids in coded:
            state = matched = 0
            for word in ids:
                state, matched = self.step(state, matched, word)
                if matched >= window:
                    self.items.setdefault(self.holding(state), set()).add(name)
            if len(ids) < window:
                self.short.setdefault(state, []).append((len(ids), name))
        self.has_short = self._inherit() if self.short else {}

    def _new(self, length: int, link: int, source: int | None = None) -> int:
        state = len(self.length)
        self.length.append(length)
        self.link.append(link)
        self.edges.append([])
        if source is not None:
            for word in self.edges[source]:
                self._set(state, word, self.next[source * self.size + word])
        return state

    def _set(self, state: int, word: int, to: int) -> None:
        if (key := state * self.size + word) not in self.next:
            self.edges[state].append(word)
        self.next[key] = to

    def _split(self, state: int, word: int, to: int) -> int:
        """The state for stretches of one word more than ``state``'s, taken out of ``to``."""
        copy = self._new(self.length[state] + 1, self.link[to], to)
        self.link[to] = copy
        while state >= 0 and self.next.get(state * self.size + word) == to:
            self.next[state * self.size + word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        to = self.next.get(last * self.size + word)
        if to is not None:
            return to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        new, state = self._new(self.length[last] + 1, 0), last
        while state >= 0 and (to := self.next.get(state * self.size + word)) is None:
            self._set(state, word, new)
            state = self.link[state]
        if state >= 0:
            exact = self.length[to] == self.length[state] + 1
            self.link[new] = to if exact else self._split(state, word, to)
        return new

    def _inherit(self) -> dict[int, int]:
        """For each state the nearest one on its chain of links that ends a short item."""
        found: dict[int, int] = {}
        for state in sorted(range(len(self.length)), key=self.length.__getitem__):
            if state in self.short:
                found[state] = state
            elif self.link[state] in found:
                found[state] = found[self.link[state]]
        return found

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """The longest stretch ending at the next word, which is in the vocabulary."""
        to = self.next.get(state * self.size + word)
        while to is None and state:
            state = self.link[state]
            matched = self.length[state]
            to = self.next.get(state * self.size + word)
        return (0, 0) if to is None else (to, matched + 1)

    def holding(self, state: int) -> int:
        """The state of the last ``window`` words of a stretch of at least that many."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def scan(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches (start, end) in order, merged, and the items that occur."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.least or len(tokens) < self.least:
            return spans, items
        ids = np.fromiter(
            map(self.vocabulary.get, tokens, repeat(-1)), np.int32, len(tokens)
        )
        runs = np.flatnonzero(np.diff(np.concatenate(([0], ids >= 0, [0])))).reshape(-1, 2)
        for start, end in runs[runs[:, 1] - runs[:, 0] >= self.least]:  # of known words
            state = matched = 0
            for at, word in enumerate(ids[start:end].tolist(), int(start) + 1):
                state, matched = self.step(state, matched, word)
                hit = 0
                if matched >= self.window:
                    hit = matched
                    items |= self.items[self.holding(state)]
                short = self.has_short.get(state)
                while short is not None:
                    for length, name in self.short[short]:
                        if length <= matched:
                            hit = max(hit, length)
                            items.add(name)
                    short = self.has_short.get(self.link[short])
                if hit:
                    begin = at - hit
                    while spans and spans[-1][1] >= begin:
                        begin = min(begin, spans.pop()[0])
                    spans.append((begin, at))
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def pieces(benchmark: DataFrame, window: int = WINDOW, longest: int = SHARD_WORDS // 4) -> DataFrame:
    """Items as word lists of bounded length; pieces of an item share window-1 words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for name, raw in zip(*(part.column(c).to_pylist() for c in ("item", "raw"))):
                    ws = words(raw)
                    for at in range(0, max(1, len(ws) - window + 1), longest):
                        piece = ws[at : at + longest + window - 1]
                        rows.append((name, b" ".join(piece), len(piece)))
                names = ["item", "piece", "n"]
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.binary(), pa.int64()))],
                    names,
                )

    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), raw_text()
    )
    found = items.mapInArrow(run, "item string, piece binary, n long")
    return found.filter("n > 0").distinct()


class Shards:
    """The automata of all shards, read one at a time from a table in the shared folder."""

    _last: tuple[list[str], "Automaton"] | None = None  # of this worker

    def __init__(self, paths: list[str], count: int):
        self.paths, self.count = paths, count

    def __len__(self) -> int:
        return self.count

    def __iter__(self) -> Iterator[Automaton]:
        """Each shard in turn. A shard that is alone stays with the worker for its next task."""
        if self.count == 1 and Shards._last and Shards._last[0] == self.paths:
            yield Shards._last[1]
            return
        for path in self.paths:
            files, name = place(path)
            with files.open_input_file(name) as source:
                for row in pq.ParquetFile(source).iter_batches(1, columns=["automaton"]):
                    machine = pickle.loads(row.column(0)[0].as_py())
                    if self.count == 1:
                        Shards._last = (self.paths, machine)
                    yield machine


def automata(benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> Shards:
    """One automaton for each shard of about ``shard_words`` words, built by the task that
    has the shard and stored in the shared folder. Only the names of the files that hold
    them come to the driver.
    """
    cut = pieces(benchmark, window, max(1, shard_words // 4))
    total = cut.agg(F.sum("n")).first()[0] or 0
    count = -(-total // shard_words)
    if not count:
        return Shards([], 0)

    def build(rows: pa.Table) -> pa.Table:
        items = [
            (name.as_py(), piece.as_py().split())
            for name, piece in zip(rows.column("item"), rows.column("piece"))
        ]
        return pa.table({"automaton": pa.array([pickle.dumps(Automaton(items, window))], pa.binary())})

    shard = F.pmod(F.xxhash64("item", "piece"), F.lit(count))
    sharded = cut.select(shard.alias("shard"), "item", "piece")
    built = stored(sharded.groupBy("shard").applyInArrow(build, "automaton binary"), keep=True)
    return Shards(sorted(built.inputFiles()), built.count())


def _blocks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int
) -> Iterator[list[pa.RecordBatch]]:
    """Slices of batches, in lists of at least ``limit`` bytes of text but for the last."""
    block, size = [], 0
    for batch in batches:
        for part in slices(batch, column):
            block.append(part)
            size += part.column(column).nbytes
            if size >= limit:
                yield block
                block, size = [], 0
    if block:
        yield block


def _passes(frame: DataFrame, shards: Shards, names: tuple[str, ...] = (TEXT, SPANS, ITEMS)) -> DataFrame:
    """Adds hit spans (starts and ends in words, flat) and items of every shard.

    ``names``: the column of the texts, and those to add. A task holds one shard and one
    block of texts at a time; several shards are read anew for each block.
    """
    limit = BLOCK if len(shards) > 1 else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, names[0], limit):
            found = [[([], set()) for _ in range(part.num_rows)] for part in block]
            for machine in shards:
                for part, hits in zip(block, found):
                    for at, raw in enumerate(part.column(names[0])):
                        spans, items = machine.scan(words(raw.as_py()))
                        old, seen = hits[at]
                        if spans:
                            hits[at] = (merged(old + spans) if old else spans, seen | items)
            for part, hits in zip(block, found):
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([[x for span in spans for x in span] for spans, _ in hits], pa.list_(pa.int32())),
                        pa.array([sorted(items) for _, items in hits], pa.list_(pa.string())),
                    ],
                    [*part.schema.names, *names[1:]],
                )

    schema = StructType(list(frame.schema.fields))
    schema.add(names[1], ArrayType(IntegerType())).add(names[2], ArrayType(StringType()))
    return frame.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, hit stretches (words, flat) and items found."""
    frame = _passes(
        docs.select(F.col("doc_id").cast("long"), raw_text().alias(TEXT)), automata(benchmark, window)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, TEXT):
                spans = [x or [] for x in part.column(SPANS).to_pylist()]
                items = [x or [] for x in part.column(ITEMS).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(words(x)) for x in part.column(TEXT).to_pylist()], pa.int64()),
                        pa.array([sum(s[1::2]) - sum(s[::2]) for s in spans], pa.int64()),
                        pa.array([len(x) for x in items], pa.int64()),
                        pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                        pa.array(spans, pa.list_(pa.int32())),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    "doc_id n_words n_hit n_items items_sha256 spans items".split(),
                )

    return frame.mapInArrow(
        run,
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
        "spans array<int>, items array<string>",
    )


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def without(raw: bytes, spans: list[int]) -> bytes:
    """The text without the words of the spans, and what stands between them."""
    places = [m.span() for m in _WORD.finditer(raw)]
    kept, at = [], 0
    for start, end in zip(spans[::2], spans[1::2]):
        kept.append(raw[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join((*kept, raw[at:]))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    longest: int = WINDOW,
    coverage: float = 0.5,
) -> DataFrame:
    """Documents with hit stretches of ``longest`` words or more, and short items, cut out.

    A text of which more than ``coverage`` of the words is hit goes as a whole. The
    columns stay; ``n_chars``, if there, is the new length of a changed text.
    """
    names, schema = docs.columns, docs.schema
    added = tuple(new_names(names, "raw", "spans", "items"))  # docs may have any columns
    frame = docs.select("*", raw_text().alias(added[0]))
    frame = _passes(frame, automata(benchmark, window), added)
    least = min(longest, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, added[0]):
                kept, texts, sizes = [], [], []
                raws, spans = (part.column(c).to_pylist() for c in added[:2])
                olds = part.column("text").to_pylist()
                counts = part.column("n_chars").to_pylist() if "n_chars" in names else olds
                for raw, hit, old, count in zip(raws, spans, olds, counts):
                    if not hit:
                        kept.append(True), texts.append(old), sizes.append(count)
                        continue
                    n_hit = sum(hit[1::2]) - sum(hit[::2])
                    kept.append(n_hit <= coverage * len(words(raw)))
                    long = [
                        x
                        for s, e in zip(hit[::2], hit[1::2])
                        if e - s >= longest or e - s < least
                        for x in (s, e)
                    ]
                    text = without(raw, long).decode("utf-8", "replace")
                    texts.append(text), sizes.append(len(text))
                columns = []
                for name in names:
                    column = part.column(name)
                    if name == "text":
                        column = pa.array(texts, column.type)
                    elif name == "n_chars":
                        column = pa.array(sizes, column.type)
                    columns.append(column)
                out = pa.RecordBatch.from_arrays(columns, names)
                yield out.filter(pa.array(kept, pa.bool_()))

    return frame.mapInArrow(run, schema)

