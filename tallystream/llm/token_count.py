"""Token counts by a two-tier lookup, without a shuffle of pre-tokens.

A text is cut before every single space that a non-space follows. The byte-level
pre-tokenizer always has a boundary there, and what it does behind one does not
depend on what stands before, so the counts of the pieces add up to the text's.

Tier one is a broadcast table of the lengths of frequent pieces, of bounded
size. It comes from a bounded sample of documents, by a hash of doc_id: each task sends one
row, the most frequent pieces of its part of the sample, so no piece is shuffled. Tier two
is a bounded cache in each worker; the pieces of a slice that neither has are encoded
together. Pieces of more than ``LONG`` characters are encoded as they come and kept in
neither. The tables change the speed only, never a count.

Null and empty texts have no bytes and no tokens. Repeated documents each get a
row. A very long text is cut into pieces like any other; one without spaces is a single
piece, which the library encodes whole. An empty table gives no rows. Only doc_id and text
are read; other columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.llm.texts import raw_text, slices

FREQUENT = 32_768  # entries of the broadcast table, and those that a task of the sample sends
SAMPLE = 2_048  # documents that the table comes from, at most
CACHE = 400_000  # entries of a worker's cache
LONG = 64  # characters of a piece, above which it is kept in no table

# A space that white space or the end of the text follows is not cut at by split(" ").
_ODD = re.compile(r" (?:[\s᠎]|$)")
_CUT = re.compile(r" (?=[^\s᠎])")

# Per worker process: tokenizers by path, and caches of lengths by path.
_TOKENIZERS: dict[str, object] = {}
_CACHES: dict[str, dict[str, int]] = {}


def tokenizer(path: str):
    """The tokenizer of a file, once per worker process."""
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        _TOKENIZERS[path] = loaded
    return _TOKENIZERS[path]


def token_pieces(text: str) -> list[str]:
    """Pieces whose tokens add up to the text's; a space stood before all but the first."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


def _stem(piece: str) -> str:
    """The piece without a last comma or full stop that follows a letter or digit.

    There is always a boundary before that sign, which is one token.
    """
    return piece[:-1] if piece[-1:] in (",", ".") and piece[-2:-1].isalnum() else piece


def _lengths(path: str, pieces: list[str]) -> list[int]:
    encoded = tokenizer(path).encode_batch(pieces, add_special_tokens=False)
    return [len(e.ids) for e in encoded]


def frequent_pieces(docs: DataFrame, path: str, entries: int, sample: int) -> dict[str, int]:
    """Token counts of the most frequent pieces of at most ``sample`` documents."""
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).filter("id IS NOT NULL").distinct()
    picked = F.broadcast(ids.orderBy(F.xxhash64("id"), "id").limit(sample))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                for raw in part.column("raw").to_pylist():
                    pieces = token_pieces(raw.decode("utf-8", "replace"))[1:]
                    seen.update(p for p in pieces if len(p) <= LONG)
                    if len(seen) > 2 * entries:
                        seen = Counter(dict(seen.most_common(entries)))
        top = [(k, v) for k, v in seen.most_common(entries) if v > 1]
        if top:
            columns = [pa.array([column]) for column in zip(*top)]
            yield pa.RecordBatch.from_arrays(columns, ["pieces", "n"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text())
    rows = rows.join(picked, F.col("doc_id") == F.col("id")).select("raw")
    total: Counter = Counter()
    for r in rows.mapInArrow(count, "pieces array<string>, n array<long>").toLocalIterator():
        total.update(dict(zip(r.pieces, r.n)))  # one row a task that has part of the sample
    top = [piece for piece, _ in total.most_common(entries)]
    lengths = _lengths(path, [f" {p}" for p in top])
    return dict(zip(top, lengths))


def slice_lengths(
    path: str, wanted: set[str], frequent: dict[str, int], cache: dict[str, int]
) -> dict[str, int]:
    """Token counts of pieces, each after a space; what neither table has is encoded."""
    found: dict[str, int] = {}
    missing = []
    for piece in wanted:
        n = frequent.get(piece) or cache.get(piece)
        if n is None:
            missing.append(piece)
        else:
            found[piece] = n
    stems = {p: _stem(p) for p in missing}
    new = [s for s in {*stems.values()} if s not in found]
    lengths = dict(zip(new, _lengths(path, [f" {s}" for s in new])))
    for piece, stem in stems.items():
        n = found[stem] if stem in found else lengths[stem]
        found[piece] = n + (piece != stem)
    if len(cache) + len(missing) > CACHE:
        cache.clear()
    cache.update((p, found[p]) for p in missing if len(p) <= LONG)
    return found


def token_counts(docs: DataFrame, path: str, limit: int = 512, entries: int = FREQUENT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens and whether they are over the limit.

    ``path``: a tokenizer file of byte-level pieces, readable by the workers.
    Special strings in a text count as the library takes them, as one token.
    """
    table = docs.sparkSession.sparkContext.broadcast(
        frequent_pieces(docs, path, entries, SAMPLE) if entries else {}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = table.value
        cache = _CACHES.setdefault(path, {})
        for batch in batches:
            for part in slices(batch):
                raws = part.column("raw").to_pylist()
                cut = [token_pieces(r.decode("utf-8", "replace")) if r else [] for r in raws]
                first = _lengths(path, [pieces[0] if pieces else "" for pieces in cut])
                rest = [pieces[1:] for pieces in cut]
                lengths = slice_lengths(path, {p for r in rest for p in r}, frequent, cache)
                known = lengths.__getitem__
                counts = [head + sum(map(known, r)) for head, r in zip(first, rest)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(map(len, raws), pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([n > limit for n in counts], pa.bool_()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select(F.col("doc_id").cast("long"), raw_text()).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
