"""Quality classifier: random-indexing word vectors and a two-layer network.

Words and word shapes (letter case, digits, signs) are hashed into a fixed number
of rows, so that words share vectors: the table's size is the same for every corpus. Every row has a fixed sparse index vector; a row's word vector is the sum
of the index vectors of its neighbours over all documents of the corpus, summed in
the tasks and then by row. A document is pooled to the means of its words' and
shapes' unit vectors, their lengths, and how alike neighbouring words are. A
two-layer numpy network is trained on a bounded sample of labelled rows, and its
temperature fitted on a part of the sample that the training does not see.

Labels come only from rows whose crc32(doc_id as text) mod 5 is not 0. Labels,
lang, source and doc_id are no inputs. Null and empty texts pool to zeros and get
the score of that. Without usable labels every score is 0.5; with labels of one
kind it is that kind's rate, smoothed. Rows with a null doc_id are scored, and
not held out. Repeated documents each get a row. Labels of a null or repeated
doc_id: null ones are dropped, repeated ones all used. Very long texts are pooled whole, in
blocks of words. An empty table gives no rows. Other columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.texts import mix, pieces, raw_text, slices

WORD_ROWS = 8192
SHAPE_ROWS = 512
ROWS = WORD_ROWS + SHAPE_ROWS
DIM = 32
NONZERO = 2  # entries of an index vector that are +1 or -1
WINDOW = 2  # neighbours on either side
SAMPLE = 8_000  # labelled rows that the network is fitted on, at most
HIDDEN = 16
THRESHOLD = 0.3
CACHE = 300_000
BLOCK = 1 << 16  # words that are worked on at once
COUNTED_AT_ONCE = 2 << 20  # bytes of text, while neighbours are counted

_SHAPE = bytes(
    65 if 65 <= c <= 90 else 97 if c > 127 or 97 <= c <= 122 else 48 if 48 <= c <= 57 else c
    for c in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)


class _Rows(dict):
    """Row of a word and of its shape, packed; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        shape = _RUN.sub(rb"\1\1", word.translate(_SHAPE))
        row = zlib.crc32(word.lower()) % WORD_ROWS
        value = self[word] = row * SHAPE_ROWS + zlib.crc32(shape) % SHAPE_ROWS
        return value


_KNOWN = _Rows()


def token_rows(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word rows, shape rows and bounds of the texts' words, split at white space."""
    known = _KNOWN.__getitem__
    counts, found = [0], [np.empty(0, np.int64)]
    for raw in raws:
        n = 0
        for piece in pieces(raw):
            words = piece.split()
            found.append(np.fromiter(map(known, words), np.int64, len(words)))
            n += len(words)
        counts.append(n)
    packed = np.concatenate(found)
    return packed // SHAPE_ROWS, WORD_ROWS + packed % SHAPE_ROWS, np.cumsum(counts)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of all rows' index vectors."""
    draw = mix(np.arange(1, ROWS * NONZERO + 1)).reshape(ROWS, NONZERO)
    return (draw % np.uint64(DIM)).astype(np.int64), np.where(draw >> np.uint64(63), 1.0, -1.0)


def add_contexts(
    sums: np.ndarray, text: np.ndarray, words: np.ndarray, shapes: np.ndarray, block: int
) -> None:
    """Adds to each row's sum the index vectors of its neighbours in the same text.

    Only pairs that begin within the first ``block`` words count.
    """
    place, sign = index_vectors()
    code = 2 * place + (sign < 0)  # place and sign of an entry in one number
    keys = []
    for rows in (words, shapes):
        for step in range(1, WINDOW + 1):
            left, right = rows[:-step][:block], rows[step:][:block]
            near = (text[step:] == text[:-step])[:block]
            left, right = left[near], right[near]
            for a, b in ((left, right), (right, left)):
                keys += [a * (2 * DIM) + code[b, k] for k in range(NONZERO)]
    found = np.bincount(np.concatenate(keys), minlength=2 * ROWS * DIM).reshape(ROWS, DIM, 2)
    sums += found[:, :, 0] - found[:, :, 1]


def context_sums(docs: DataFrame) -> np.ndarray:
    """Word vectors of all rows, over the whole corpus. ROWS x DIM numbers at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((ROWS, DIM), np.int64)
        for batch in batches:
            for part in slices(batch, limit=COUNTED_AT_ONCE):
                words, shapes, bounds = token_rows(part.column("raw").to_pylist())
                for at in range(0, len(words), BLOCK):
                    # Neighbours reach over a block's end, but not over a text's.
                    to = at + BLOCK + WINDOW
                    text = np.searchsorted(bounds, np.arange(at, min(to, len(words))), "right")
                    add_contexts(sums, text, words[at:to], shapes[at:to], BLOCK)
        used = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), *(pa.array(sums[used, k]) for k in range(DIM))], names
        )

    names = ["row", *(f"v{k}" for k in range(DIM))]
    parts = docs.select(raw_text()).mapInArrow(run, ", ".join(f"{n} long" for n in names))
    summed = parts.groupBy("row").agg(*(F.sum(n).alias(n) for n in names[1:]))
    table = np.zeros((ROWS, DIM))
    for r in summed.collect():
        table[r.row] = r[1:]
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(raws: list[bytes], table: np.ndarray) -> np.ndarray:
    """One row of features per text."""
    words, shapes, bounds = token_rows(raws)
    out = np.zeros((len(raws), 2 * (DIM + 3) + 1))
    for k, (s, e) in enumerate(zip(bounds[:-1], bounds[1:])):
        for part, rows in enumerate((words, shapes)):
            at = part * (DIM + 3)
            for start in range(s, e, BLOCK):
                # One word of the block before, for the pair across the blocks' edge.
                near = rows[max(s, start - 1) : min(e, start + BLOCK)]
                vectors = table[near]
                out[k, at : at + DIM] += vectors[start - max(s, start - 1) :].sum(axis=0)
                if len(near) > 1:
                    out[k, at + DIM + 1] += np.dot(vectors[1:].ravel(), vectors[:-1].ravel())
                    out[k, at + DIM + 2] += np.count_nonzero(near[1:] == near[:-1])
            out[k, at : at + DIM + 3] /= max(e - s, 1)
            out[k, at + DIM] = np.linalg.norm(out[k, at : at + DIM])
    out[:, -1] = np.log1p(np.diff(bounds)) / 10
    return out


class Network:
    """Two layers with tanh and sigmoid; standardised inputs; a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 1, epochs: int = 60):
        rng = np.random.default_rng(seed)
        rate = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        self.constant = rate if len(y) < 10 or y.min() == y.max() else None
        self.temperature = 1.0
        if self.constant is not None:
            return
        self.shift, self.scale = x.mean(0), x.std(0) + 1e-3
        z = (x - self.shift) / self.scale
        order = rng.permutation(len(y))
        cut = max(1, len(y) // 5)
        held, fit = order[:cut], order[cut:]
        self.weights = [
            rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
            np.zeros(1),
        ]
        moment = [np.zeros_like(w) for w in self.weights]
        square = [np.zeros_like(w) for w in self.weights]
        step = 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(fit), max(1, len(fit) // 128)):
                step += 1
                grads = self._gradients(z[rows], y[rows])
                for w, m, v, g in zip(self.weights, moment, square, grads):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        logit = self._logit(z[held])
        choices = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        self.temperature = float(min(choices, key=lambda t: self._loss(logit / t, y[held])))

    @staticmethod
    def _loss(logit: np.ndarray, y: np.ndarray) -> float:
        return float((np.logaddexp(0, logit) - y * logit).mean())

    def _logit(self, z: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh(z @ a + b) @ c + d

    def _gradients(self, z: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        a, b, c, d = self.weights
        hidden = np.tanh(z @ a + b)
        off = (1 / (1 + np.exp(-(hidden @ c + d))) - y) / len(y)
        back = off[:, None] * c * (1 - hidden**2)
        return [z.T @ back + 1e-4 * a, back.sum(0), hidden.T @ off + 1e-4 * c, off.sum(keepdims=True)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logit = self._logit((x - self.shift) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, table: np.ndarray, limit: int):
    """Features and labels of at most ``limit`` labelled documents, picked by hash."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    usable = usable.filter(~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("quality")
    )
    picked = usable.orderBy(F.xxhash64("labelled"), "labelled", "quality").limit(limit)
    rows = docs.select("doc_id", raw_text()).join(  # at most ``limit`` rows of two numbers
        F.broadcast(picked), F.col("doc_id") == F.col("labelled")
    )
    width = 2 * (DIM + 3) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = pooled(part.column("raw").to_pylist(), table)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("quality"),
                        pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(
                            pa.list_(pa.float64())
                        ),
                    ],
                    ["doc_id", "quality", "x"],
                )

    found = rows.select(F.col("doc_id").cast("long"), "raw", "quality").mapInArrow(
        run, "doc_id long, quality int, x array<double>"
    )
    # Documents of one id may be many: the bound holds for the rows fetched, too.
    taken = found.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "x").limit(limit).collect()
    x = np.array([r.x for r in taken]).reshape(len(taken), width)
    return x, np.array([r.quality for r in taken], np.float64)


def quality_scores(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, held_out, score (higher: good likelier), predicted."""
    table = context_sums(docs)
    network = Network(*training_sample(docs, labels, table, limit))
    model = docs.sparkSession.sparkContext.broadcast((table, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, network = model.value
        for batch in batches:
            for part in slices(batch):
                scores = network.scores(pooled(part.column("raw").to_pylist(), table))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(scores),
                        pa.array((scores >= THRESHOLD).astype(np.int32)),
                    ],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        raw_text(),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
