"""Near-duplicate classes by ProbMinHash.

Texts are weighted sets of five-word shingles, a shingle's weight being how often
it occurs. Each shingle sends out the arrivals of a Poisson process of its
weight's rate, each to a random component of the signature; a component keeps
its first arrival, and a shingle stops once it is later than all components.
Two signatures agree in a component with the probability Jaccard similarity
J_P = sum over shared i of 1 / sum over j of max(a_j/a_i, b_j/b_i), which is the
plain Jaccard similarity where no shingle repeats.

Equal texts are joined first, by a 128-bit digest of their words. Signatures are
cut into bands; texts that share a band are compared in full, by J_P.

The pairs of a band are not listed. First each text is compared with one other, the
best of its bands' leaders: the leader is the text that meets most others in all its
bands. Links join texts to classes. Then texts are compared with the other leaders of
their bands that are of another class. A band whose texts are all of one class by then is
done: a link within it would change nothing. Of the others only pairs of texts from two
classes are left. These are met in tiles of bitmaps, one bit a shingle: bits that one of
two texts has alone bound the weight that they share, and so J_P (``most_similar``, exact
for texts without repeated shingles up to shared bits). What the bound leaves, each pair
in the first band that it shares, is compared in full. So no link within a band is lost,
however large it is; bands are dealt out as pairs of parts of a bounded size.
Classes are the connected components of the links. A pair at similarity 0.8 shares a band
with probability 1 - (1 - 0.8^5)^25 = 0.99995.

Texts of fewer than five words are one shingle. Texts without words are equal if their
bytes are; empty and null ones have no copies, each is a class of its own. Rows that share a doc_id may
differ in text. A class is named by its least doc_id, null if it has none but
null. Only doc_id and text are read; ``near_distinct`` keeps all columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallystream.llm.texts import (
    freed_shuffles,
    freed_tables,
    join_counted,
    mix,
    new_names,
    raw_text,
    shared_checkpoints,
    slices,
    split_groups,
    stored,
    word_hashes,
)

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 25
BAND_ROWS = 5
PAIRS_AT_ONCE = 4096  # pairs of one text, above which it is sent to several tasks
TILE = 64
LEAST_BITS = 1024  # of a bitmap
BITS_A_SHINGLE = 32
BLOCK_BYTES = 4 << 20  # of bitmaps of one band, above which it is split
BROADCAST_KEYS = 500_000  # keys up to which they are broadcast, 16 bytes each
BROADCAST_ROOTS = 100_000  # texts with links up to which their roots are broadcast, 32 bytes each
BROADCAST_BYTES = 10 << 20  # bytes of texts up to which they are broadcast, Spark's default

_BASE = np.uint64(0x9E3779B97F4A7C15)
_GOLDEN = np.uint64(0xD1B54A32D192ED03)


def weighted_shingles(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text number, shingle, weight) of all texts, sorted by the first two."""
    n, counts = len(hashes), np.diff(bounds)
    text = np.repeat(np.arange(len(counts)), counts)
    rolled = hashes.copy()
    for k in range(1, SHINGLE):
        m = max(0, n - k)
        rolled[:m] = rolled[:m] * _BASE + hashes[n - m :]
    last = np.repeat(bounds[1:], counts) - np.arange(n) < SHINGLE  # fewer words from here on
    full = np.repeat(counts >= SHINGLE, counts)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    lone = counts[short].astype(np.uint64)
    for k in range(SHINGLE - 1):
        more = counts[short] > k
        lone[more] = lone[more] * _BASE + hashes[bounds[:-1][short[more]] + k]
    text = np.concatenate((text[full & ~last], short))
    shingle = mix(np.concatenate((rolled[full & ~last], lone)))
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    new = np.ones(len(text), np.bool_)
    new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(text))).astype(np.float64)
    return text[at], shingle[at], weight


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, size: int) -> np.ndarray:
    """ProbMinHash signatures of n texts: the shingle that arrives first at each component."""
    first = np.full(n * size, np.inf)
    latest = np.full(n, np.inf)
    time = np.zeros(len(text))
    active = np.arange(len(text))
    seen = []
    salt = np.zeros(1, np.uint64)
    while len(active):
        salt += _GOLDEN  # an array, for it wraps around
        draw = mix(shingle[active] + salt)
        # 53 bits for the time to the next arrival, the low 11 for its component.
        time[active] -= np.log(((draw >> np.uint64(11)) + 0.5) * 2.0**-53) / weight[active]
        part = ((draw & np.uint64(0x7FF)) * np.uint64(size)) >> np.uint64(11)
        slot = text[active] * size + part.astype(np.int64)
        now = time[active]
        np.minimum.at(first, slot, now)
        seen.append((slot, now, active))
        texts = np.unique(text[active]) if len(active) < n else np.arange(n)
        latest[texts] = first.reshape(n, size)[texts].max(axis=1)
        active = active[now < latest[text[active]]]
    found = np.zeros(n * size, np.uint64)
    for slot, now, which in seen:
        won = first[slot] == now
        found[slot[won]] = shingle[which[won]]
    return found.reshape(n, size)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """J_P of two weighted sets (sorted members, weights).

    With r_j = b_j / a_j the inner maximum is a_j / a_i where r_j <= r_i and b_j / b_i
    elsewhere, so that sums in the order of r give all terms.
    """
    members = np.union1d(a[0], b[0])
    x, y = np.zeros(len(members)), np.zeros(len(members))
    x[np.searchsorted(members, a[0])] = a[1]
    y[np.searchsorted(members, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = y / x
    order = np.argsort(ratio)
    x, y, ratio = x[order], y[order], ratio[order]
    upto = np.searchsorted(ratio, ratio, "right")
    low, high = np.append(0, np.cumsum(x)), np.append(0, np.cumsum(y))
    shared = (x > 0) & (y > 0)
    x, y, upto = x[shared], y[shared], upto[shared]
    return float((1 / (low[upto] / x + (high[-1] - high[upto]) / y)).sum())


def text_keys(raws: list[bytes]) -> tuple[list[bytes | None], np.ndarray, np.ndarray]:
    """A 16-byte digest of each text's words, of its bytes if it has none, null if it is
    empty; and the words' hashes."""
    hashes, bounds = word_hashes(raws)
    keys = [
        hashlib.blake2b(hashes[s:e].tobytes(), digest_size=16).digest()
        if e > s
        else hashlib.blake2b(raw, digest_size=16, person=b"no words").digest() if raw else None
        for s, e, raw in zip(bounds[:-1], bounds[1:], raws)
    ]
    return keys, hashes, bounds


def sketch(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, key of its text, hashes of its signature's bands."""
    salts = mix(np.arange(1, BANDS + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys, hashes, bounds = text_keys(part.column("raw").to_pylist())
                found = signatures(
                    *weighted_shingles(hashes, bounds), len(keys), BANDS * BAND_ROWS
                ).reshape(-1, BANDS, BAND_ROWS)
                band = np.broadcast_to(salts, found.shape[:2])
                for k in range(BAND_ROWS):
                    band = mix(band * _BASE + found[:, :, k])
                worded = np.diff(bounds) > 0  # texts without words are in no band
                filled = band.view(np.int64)[worded].ravel()
                ends = np.append(0, np.cumsum(worded * BANDS)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(keys, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(filled)),
                    ],
                    ["doc_id", "key", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), raw_text()).mapInArrow(
        run, "doc_id long, key binary, bands array<long>"
    )


def _some(frame: DataFrame, n: int) -> DataFrame:
    return F.broadcast(frame) if n <= BROADCAST_KEYS else frame


def _counted(frame: DataFrame, which: str = "true") -> tuple[DataFrame, int]:
    """The frame stored, and how many of its rows are such, counted as it is written."""
    seen = Observation()
    frame = stored(frame.observe(seen, F.count(F.when(F.expr(which), 1)).alias("n")))
    return frame, seen.get["n"]


def _few(roots: DataFrame) -> DataFrame:
    """Roots, as they are joined: broadcast if they are counted to be few."""
    return F.broadcast(roots) if roots.count() <= BROADCAST_ROOTS else roots


def candidate_texts(docs: DataFrame, texts: DataFrame, members: DataFrame) -> DataFrame:
    """(key, raw): the texts in bands with others, once each."""
    wanted, n = _counted(members.select("key").join(texts.select("key", "doc_id"), "key"))
    ids = wanted.select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long"), raw_text())
    rows = rows.join(_some(ids, n), rows["doc_id"].eqNullSafe(ids["id"]), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys = text_keys(part.column("raw").to_pylist())[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), part.column("raw")], ["key", "raw"]
                )

    # Rows of one doc_id may have other texts than the wanted one, or the same twice.
    found = rows.mapInArrow(run, "key binary, raw binary")
    found = found.join(_some(wanted.select("key"), n), "key", "left_semi")
    return found.dropDuplicates(["key"])


def _with_text(pairs: DataFrame, side: str, many: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs with the text of one side, in a column of that name with "_raw".

    ``many``: (of, copies) of the texts in many pairs; these are sent to several tasks.
    """
    spread = F.pmod(F.xxhash64("key", "leader"), F.coalesce("copies", F.lit(1))).cast("int")
    pairs = pairs.join(many, F.col(side) == F.col("of"), "left").withColumn("copy", spread)
    pairs = pairs.drop("of", "copies")
    named = texts.select(F.col("key").alias("text_key"), F.col("raw").alias(f"{side}_raw"))
    named = named.join(many, F.col("text_key") == F.col("of"), "left")
    last = F.coalesce("copies", F.lit(1)) - 1
    named = named.withColumn("number", F.explode(F.sequence(F.lit(0), last)))
    on = (F.col(side) == F.col("text_key")) & (F.col("copy") == F.col("number"))
    return pairs.join(named.drop("of", "copies"), on).drop("text_key", "number", "copy")


def compare(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(key, leader, similarity) of pairs; in full where it can reach ``least``.

    A pair for which the bound of ``most_similar`` is below ``least`` gets that bound.
    """
    sides = stored(pairs)
    for side in ("key", "leader"):
        many = sides.groupBy(F.col(side).alias("of")).agg(F.count("*").alias("pairs"))
        many = many.filter(F.col("pairs") > PAIRS_AT_ONCE)
        many = many.select("of", F.ceil(F.col("pairs") / PAIRS_AT_ONCE).cast("int").alias("copies"))
        sides = _with_text(sides, side, _some(*_counted(many)), texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "key_raw"):
                keys, leaders = (part.column(c).to_pylist() for c in ("key", "leader"))
                raws = dict(zip(keys, part.column("key_raw").to_pylist()))
                raws.update(zip(leaders, part.column("leader_raw").to_pylist()))
                sets = _sets(raws)
                found = [_score(sets[a], sets[b], least) for a, b in zip(keys, leaders)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("leader"), pa.array(found, pa.float64())],
                    ["key", "leader", "similarity"],
                )

    return sides.select("key", "leader", "key_raw", "leader_raw").mapInArrow(
        run, "key binary, leader binary, similarity double"
    )


# Per worker process: weighted sets of the texts last seen, by key.
_SETS: dict[bytes, tuple[np.ndarray, ...]] = {}
SETS_MEMBERS = 1_000_000  # members of all sets that are kept


def _sets(raws: dict[bytes, bytes]) -> dict[bytes, tuple[np.ndarray, ...]]:
    """(shingles, weights, weights that add up to 1) of texts."""
    new = [k for k in raws if k not in _SETS]
    text, shingle, weight = weighted_shingles(*word_hashes([raws[k] for k in new]))
    at = np.searchsorted(text, np.arange(len(new) + 1))
    out = {k: _SETS[k] for k in raws if k in _SETS}
    if sum(len(v[0]) for v in _SETS.values()) + len(text) > SETS_MEMBERS:
        _SETS.clear()
    for k, s, e in zip(new, at[:-1], at[1:]):
        part = weight[s:e].copy()
        out[k] = shingle[s:e].copy(), part, part / part.sum()
    if len(text) <= SETS_MEMBERS:
        _SETS.update((k, out[k]) for k in new)
    return out


def most_similar(shared: np.ndarray, led_shared: np.ndarray) -> np.ndarray:
    """The greatest J_P of two texts, from the share of either's weight in shared shingles.

    A shared shingle's term is at most 1 / (u/p + v/q + max(1/p, 1/q)), with p and q its
    weights over the shared weight of either text, and u and v what is not shared, likewise.
    That is concave and homogeneous in (p, q), so that the sum over all is at most its
    value at (1, 1), 1 / (1 + u + v). For sets it is the plain Jaccard similarity itself.
    """
    with np.errstate(divide="ignore"):
        return 1 / (1 / np.float64(shared) + 1 / np.float64(led_shared) - 1)


def _score(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], least: float) -> float:
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = b[0][at] == a[0]
    bound = float(most_similar(a[2][both].sum(), b[2][at[both]].sum()))
    return similarity(a[:2], b[:2]) if bound >= least - 1e-9 else bound


def bitmap(shingle: np.ndarray) -> bytes:
    """A bit for each shingle, among 32 bits a shingle or more, so that few share one."""
    size = max(LEAST_BITS, 1 << int(BITS_A_SHINGLE * len(shingle) - 1).bit_length())
    bits = np.zeros(size, np.bool_)
    bits[(shingle & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def bitmaps(texts: DataFrame) -> DataFrame:
    """(key, total, bits): weight of all shingles and a bitmap of them, of texts (key, raw)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                text, shingle, weight = weighted_shingles(
                    *word_hashes(part.column("raw").to_pylist())
                )
                ends = np.searchsorted(text, np.arange(part.num_rows + 1))
                bits = [bitmap(shingle[i:j]) for i, j in zip(ends[:-1], ends[1:])]
                total = np.bincount(text, weight, part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(total), pa.array(bits, pa.binary())],
                    ["key", "total", "bits"],
                )

    return texts.select("key", "raw").mapInArrow(run, "key binary, total double, bits binary")


def _folded(bits: list[bytes], size: int) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, larger ones folded to ``size`` bytes."""
    rows = []
    for one in bits:
        words = np.frombuffer(one, np.uint64)
        rows.append(np.bitwise_or.reduce(words.reshape(-1, size // 8), axis=0))
    return np.stack(rows)


def open_pairs(
    block: np.ndarray, root: np.ndarray, side: np.ndarray, total: np.ndarray, bits: list[bytes], least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Rows i < j of one block, not of one root, whose bitmaps allow J_P of at least ``least``.

    Rows are sorted by block. A bit that only one text has stands for at least one shingle,
    of weight one or more, that the other lacks.
    """
    size = np.array([len(b) for b in bits])
    left, right = [], []
    for at in range(0, len(block), TILE):
        a = slice(at, at + TILE)
        for to in range(at, len(block), TILE):
            if to > at and block[to] != block[a][-1]:
                break
            b = slice(to, to + TILE)
            open_ = (block[a][:, None] == block[b][None, :]) & (root[a][:, None] != root[b][None, :])
            open_ &= (side[a] < 0)[:, None] | (side[a][:, None] != side[b][None, :])
            if to == at:
                open_ = np.triu(open_, 1)
            if not open_.any():
                continue
            least_size = int(min(size[a].min(), size[b].min()))
            x, y = _folded(bits[a], least_size), _folded(bits[b], least_size)
            common = np.bitwise_count(x[:, None, :] & y[None, :, :]).sum(axis=2, dtype=np.int64)
            lone_x = np.bitwise_count(x).sum(axis=1, dtype=np.int64)[:, None] - common
            lone_y = np.bitwise_count(y).sum(axis=1, dtype=np.int64)[None, :] - common
            shared_x, shared_y = 1 - lone_x / total[a][:, None], 1 - lone_y / total[b][None, :]
            open_ &= most_similar(shared_x, shared_y) >= least - 1e-9
            i, j = np.nonzero(open_)
            left.append(i + at)
            right.append(j + to)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _open(least: float):
    """Pairs (key, leader) of rows sorted by block, each in the first band that both share."""

    def pairs(table: pa.Table) -> pa.RecordBatch:
        block = table.column("block").to_numpy()
        roots = table.column("root").to_pylist()
        number = {root: k for k, root in enumerate(set(roots))}
        i, j = open_pairs(
            block,
            np.array([number[root] for root in roots]),
            table.column("side").to_numpy(),
            table.column("total").to_numpy(),
            table.column("bits").to_pylist(),
            least,
        )
        bands = [set(b) for b in table.column("bands").take(pa.array(np.append(i, j))).to_pylist()]
        band = table.column("band").to_numpy()[i].tolist()
        first = [min(bands[k] & bands[k + len(i)]) == band[k] for k in range(len(i))]
        key = table.column("key")
        columns = [key.take(pa.array(side[np.array(first, np.bool_)])) for side in (i, j)]
        return pa.table(columns, names=["key", "leader"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            block = batch.column("block").to_numpy()
            changes = np.flatnonzero(block[1:] != block[:-1])
            if kept and len(block) and kept[-1].column("block")[-1].as_py() != block[0]:
                yield from pairs(pa.Table.from_batches(kept)).to_batches()
                kept = []
            if len(changes):
                # All but the last block are whole; that one may go on in the next batch.
                cut = int(changes[-1]) + 1
                whole = pa.Table.from_batches([*kept, batch.slice(0, cut)])
                yield from pairs(whole).to_batches()
                kept, batch = [], batch.slice(cut)
            if batch.num_rows:
                kept.append(batch)
        if kept:
            yield from pairs(pa.Table.from_batches(kept)).to_batches()

    return run


def left_pairs(members: DataFrame, texts: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """(key, leader): pairs of texts that share a band, have no common root yet, and whose
    bitmaps allow a link.

    Bands whose texts are of one class are done. In the others texts are compared in
    tiles; a band larger than ``BLOCK_BYTES`` is dealt out as pairs of its parts, so that no
    task holds more than two of these.
    """
    rows = members.join(_few(roots), "key", "left")
    rows = rows.select("key", "bands", F.coalesce("root", "key").alias("root"))
    spread = stored(rows.select("key", "root", F.explode("bands").alias("band")))
    mixed = spread.groupBy("band").agg(
        F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n")
    )
    mixed, n = _counted(mixed.filter("a != b").select("band", "n"))
    spread = stored(join_counted(spread, mixed, "band", n).drop("n"))
    keys = spread.select("key").distinct()
    held = bitmaps(texts.join(keys, "key", "left_semi")).join(members.select("key", "bands"), "key")
    spread = spread.join(held, "key").withColumn("block", F.col("band"))
    spread = split_groups(stored(spread), "key", F.length("bits") + 256, BLOCK_BYTES)
    order = ("block", F.length("bits"), "root", "key")
    spread = spread.repartition("block").sortWithinPartitions(*order)
    return spread.mapInArrow(_open(least), "key binary, leader binary")


def _leaders(exploded: DataFrame, shared: DataFrame, n: int) -> DataFrame:
    """(key, bands, first, others): a text's bands with others, the best of their leaders
    and the rest of them. The texts that meet most others lead: they are in the middle of
    a group of copies."""
    members = join_counted(exploded, shared, "band", n)
    members = members.groupBy("key").agg(
        (-F.sum("n")).alias("rank"), F.collect_list("band").alias("bands")
    )
    members = stored(members)
    spread = members.select("key", "rank", F.explode("bands").alias("band"))
    best = spread.groupBy("band").agg(
        F.min(F.struct("rank", "key")).alias("best"), F.count("*").alias("n")
    )
    led = join_counted(spread, stored(best), "band", n)
    led = led.groupBy("key").agg(F.collect_set("best").alias("all"), F.min("best").alias("first"))
    others = F.transform(F.array_except("all", F.array("first")), lambda one: one["key"])
    led = led.select(
        F.col("key").alias("of"), F.col("first.key").alias("first"), others.alias("others")
    )
    return members.join(led, F.col("key") == F.col("of")).select("key", "bands", "first", "others")


def link_classes(members: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(key, root) of texts with links: their class by all links within bands.

    ``members``: (key, bands, first, others) of texts that share a band with another.
    """
    pairs = members.filter("key != first").select("key", F.col("first").alias("leader"))
    scored = compare(pairs, texts, least).filter(F.col("similarity") >= least)
    roots = components(scored.select("key", "leader"))
    pairs = members.select("key", F.explode("others").alias("leader")).filter("key != leader")
    roots = _linked(_apart(pairs, roots), texts, roots, least)
    return _linked(left_pairs(members, texts, roots, least), texts, roots, least)


def _linked(pairs: DataFrame, texts: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """Roots after the links among the pairs were added."""
    scored, links = _counted(compare(pairs, texts, least).filter(F.col("similarity") >= least))
    return _followed(roots, components(_renamed(scored, roots).distinct())) if links else roots


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose sides are not yet in one class."""
    roots = _few(roots)
    a = roots.select(F.col("key").alias("x"), F.col("root").alias("a"))
    b = roots.select(F.col("key").alias("y"), F.col("root").alias("b"))
    named = pairs.join(a, F.col("key") == F.col("x"), "left")
    named = named.join(b, F.col("leader") == F.col("y"), "left")
    return named.filter(F.coalesce("a", "key") != F.coalesce("b", "leader")).select("key", "leader")


def _renamed(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges between the roots that their ends have so far."""
    roots = _few(roots)
    a = roots.select("key", F.col("root").alias("a"))
    b = roots.select(F.col("key").alias("leader"), F.col("root").alias("b"))
    named = edges.join(a, "key", "left").join(b, "leader", "left")
    named = named.select(
        F.coalesce("a", "key").alias("key"), F.coalesce("b", "leader").alias("leader")
    )
    return named.filter("key != leader")


def _followed(roots: DataFrame, new: DataFrame) -> DataFrame:
    """Roots after their own classes were joined; keys without a root before come in."""
    on = new.select(F.col("key").alias("root"), F.col("root").alias("further"))
    old = roots.join(on, "root", "left").select("key", F.coalesce("further", "root").alias("root"))
    return stored(old.unionByName(new.join(roots.select("key"), "key", "left_anti")))


def components(edges: DataFrame) -> DataFrame:
    """(key, root): the least key of each text's connected component.

    Each round every text takes the least root among its own and its neighbours',
    then that root's root.
    """
    both = edges.select("key", F.col("leader").alias("other")).unionByName(
        edges.select(F.col("leader").alias("key"), F.col("key").alias("other"))
    )
    both = stored(both)
    least = F.least(F.min("other"), F.first("key")).alias("root")
    roots, n = _counted(both.groupBy("key").agg(least))
    while True:
        known = F.broadcast(roots) if n <= BROADCAST_ROOTS else roots
        theirs = known.select(F.col("key").alias("other"), F.col("root").alias("theirs"))
        near = both.join(theirs, "other").groupBy("key").agg(F.min("theirs").alias("theirs"))
        taken = near.join(known, "key").select(
            "key", "root", F.least("root", "theirs").alias("taken")
        )
        jump = known.select(F.col("key").alias("taken"), F.col("root").alias("next"))
        new = taken.join(jump, "taken", "left").select(
            "key", "root", F.least("taken", F.coalesce("next", "taken")).alias("new")
        )
        new, changed = _counted(new, "new < root")
        roots = new.select("key", F.col("new").alias("root"))
        if not changed:
            return roots


def _rooted(docs: DataFrame, least: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents' sketches, different texts, and (key, root) of those with links."""
    drawn = stored(sketch(docs), keep=True)
    texts = drawn.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"), F.first("bands").alias("bands")
    )
    texts = stored(texts, keep=True)
    exploded = texts.select("key", F.explode("bands").alias("band"))
    shared = exploded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    shared, n = _counted(shared)
    members = stored(_leaders(exploded, shared, n))
    raws = stored(candidate_texts(docs, texts, members))
    held = raws.agg(F.sum(F.length("raw") + 64)).first()[0] or 0
    roots = link_classes(members, F.broadcast(raws) if held <= BROADCAST_BYTES else raws, least)
    return drawn, texts, stored(roots, keep=True)


def near_classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Per document: doc_id, key of its text, class_id (least doc_id of its class),
    class_key (a text of that document), n_copies (documents of its text)."""
    shared_checkpoints(docs.sparkSession)
    with freed_shuffles(docs.sparkSession), freed_tables(docs.sparkSession):
        drawn, texts, roots = _rooted(docs, least)
    worded = drawn.filter("key IS NOT NULL")
    known = texts.select("key", F.col("doc_id").alias("least_id"), "n_copies")
    known = known.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    first = F.min(F.struct(F.col("least_id").isNull(), "least_id", "key")).alias("first")
    named = known.groupBy("root").agg(first)
    named = named.select(
        "root", F.col("first.least_id").alias("class_id"), F.col("first.key").alias("class_key")
    )
    known = known.join(named, "root").select("key", "class_id", "class_key", "n_copies")
    lone = drawn.filter("key IS NULL").select(
        "doc_id",
        "key",
        F.col("doc_id").alias("class_id"),
        F.col("key").alias("class_key"),
        F.lit(1).cast("long").alias("n_copies"),
    )
    return worded.select("doc_id", "key").join(known, "key").select(lone.columns).unionByName(lone)


def near_distinct(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents with one of each class, with all their columns."""
    classes = stored(near_classes(docs, least))
    first = F.col("key").eqNullSafe(F.col("class_key")) & F.col("doc_id").eqNullSafe(
        F.col("class_id")
    )
    gone = classes.filter(~first).select(F.col("doc_id").alias("gone"))
    ids = classes.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.filter("doc_id IS NULL OR n > 1").isEmpty():
        gone, n = _counted(gone)
        return docs.join(_some(gone, n), docs["doc_id"] == gone["gone"], "left_anti")
    return _distinct_rows(docs, classes.filter(first & F.col("key").isNotNull()))


def _distinct_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The same where rows share a doc_id or have none: rows are told by doc_id and text."""
    key, same_id, same_key = new_names(docs.columns, "key", "same_id", "same_key")
    schema = docs.withColumn(key, F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raws = [x or b"" for x in part.column("text").cast(pa.binary()).to_pylist()]
                keys = pa.array(text_keys(raws)[0], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, keys], schema.names)

    keyed = docs.mapInArrow(run, schema)
    chosen = chosen.select(F.col("doc_id").alias(same_id), F.col("key").alias(same_key)).distinct()
    same = keyed["doc_id"].eqNullSafe(chosen[same_id]) & (keyed[key] == chosen[same_key])
    kept = keyed.join(chosen, same, "left_semi").dropDuplicates(["doc_id", key])
    return kept.unionByName(keyed.filter(F.col(key).isNull())).drop(key)
