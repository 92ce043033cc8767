"""Words, slices of Arrow batches and shared folders for the operators of this package."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that are worked on at once.
SLICE = 512 << 10

# A-Z become a-z, digits, a-z and bytes above 0x7F stay, all else is a gap.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def words(raw: bytes | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 text; none of null."""
    return raw.translate(_WORD_BYTES).split() if raw else []


def raw_text(column: str = "text") -> Column:
    """Text as bytes, so that tasks need not decode it; null is empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"")).alias("raw")


def slices(
    batch: pa.RecordBatch, column: str = "raw", limit: int = SLICE, rows: int = 2048
) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each piece has few rows and bytes of text, or a single row."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    ends, at = np.cumsum(lengths), 0
    while at < len(ends):
        done = ends[at - 1] if at else 0
        to = min(max(at + 1, int(np.searchsorted(ends, done + limit, "right"))), at + rows)
        yield batch.slice(at, to - at)
        at = to


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(raw: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Text in pieces of about ``size`` bytes, cut at white space only."""
    at = 0
    while len(raw) - at > size:
        found = _SPACE.search(raw, at + size)
        if found is None:
            break
        yield raw[at : found.start()]
        at = found.start()
    yield raw[at:]


def new_names(columns: list[str], *wanted: str) -> list[str]:
    """Column names that no given column has, in any case."""
    taken, names = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit permutation that scatters its input (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shared_checkpoints(spark: SparkSession) -> None:
    """Makes ``checkpoint()`` write to the folder in spark.checkpoint.dir.

    Only a session on one machine, with none set, gets a temporary folder.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="run-")
    context.setCheckpointDir(folder)


_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def stored(frame: DataFrame, keep: bool = False) -> DataFrame:
    """The frame written as a table below the checkpoint folder, and read from there.

    Cuts the lineage like ``checkpoint()``, and Spark knows the table's true size: behind a
    checkpoint it goes on multiplying the estimates of joins, which takes ever longer in a loop.
    """
    shared_checkpoints(frame.sparkSession)
    base = frame.sparkSession.sparkContext._jsc.sc().getCheckpointDir().get()
    path = f"{base}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    passing = _PASSING.get()
    if passing is not None and not keep:
        passing.append(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def freed_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stored`` writes in the block go at its end, but for those to keep."""
    token = _PASSING.set([])
    try:
        yield
    finally:
        paths = _PASSING.get()
        _PASSING.reset(token)
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each job started in the block go when that job ends.

    Only for steps that all end in a checkpoint, so that no later job wants the files.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


BROADCAST_KEYS = 500_000  # rows of one key and one number up to which they are broadcast
HOT_KEYS = 1_000  # a key with more than one in so many of all rows is joined apart


def join_counted(rows: DataFrame, counted: DataFrame, key: str, n: int) -> DataFrame:
    """Inner join with n rows, one a key, whose column ``n`` says how many rows have the key.

    Keys of very many rows, at most ``HOT_KEYS``, are broadcast, so that none lands in one
    task. ``rows`` is read again for each part: it should be stored or cheap.
    """
    if n <= BROADCAST_KEYS:
        return rows.join(F.broadcast(counted), key)
    bound = (counted.agg(F.sum("n")).first()[0] or 0) / HOT_KEYS
    hot = F.broadcast(counted.filter(F.col("n") > bound))
    rest = rows.join(hot.select(key), key, "left_anti").join(counted, key)
    return rows.join(hot, key).unionByName(rest)


def split_groups(rows: DataFrame, member: str, weight: Column, limit: int) -> DataFrame:
    """Splits the groups of rows with one ``block`` that weigh more than ``limit``.

    Such a group becomes groups for each pair of its parts, of which each part meets itself
    and each other one once. ``side`` is 0 or 1 where two parts meet, else -1. Rows should
    be stored; groups are counted first.
    """
    large = rows.groupBy(F.col("block").alias("of")).agg(F.sum(weight).alias("held"))
    large = stored(large.filter(F.col("held") > limit))
    count = large.count()
    if not count:
        return rows.withColumn("side", F.lit(-1))
    large = F.broadcast(large) if count <= BROADCAST_KEYS else large
    parts = F.ceil(2 * F.col("held") / limit).cast("int")
    split = rows.join(large, F.col("block") == F.col("of"), "left")
    split = split.withColumn("parts", F.coalesce(parts, F.lit(1))).drop("of", "held")
    mine = F.pmod(F.xxhash64(member), F.col("parts")).cast("int")
    split = split.withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    pair = F.xxhash64("block", F.least("mine", "other"), F.greatest("mine", "other"))
    alone = F.col("mine") == F.col("other")
    return (
        split.withColumn("block", F.when(F.col("parts") > 1, pair).otherwise(F.col("block")))
        .withColumn("side", F.when(alone, -1).otherwise((F.col("mine") > F.col("other")).cast("int")))
        .drop("parts", "mine", "other")
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STEP = np.uint64(0x100000001B3)  # odd, so that it has an inverse modulo 2^64
_BACK = np.uint64(pow(0x100000001B3, -1, 1 << 64))
_BLOCK = 1 << 20
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the step and of its inverse, kept by the process."""
    if not _POWERS or len(_POWERS[0]) < n:
        up, down = np.full(n, _STEP, np.uint64), np.full(n, _BACK, np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = np.cumprod(up), np.cumprod(down)
    return _POWERS[0][:n], _POWERS[1][:n]


def _block_hashes(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of normalised bytes."""
    letters = np.frombuffer(block, np.uint8)
    solid = np.concatenate(([False], letters != 32, [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(letters) + 1)
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(letters * up[: len(letters)], out=sums[1:])
    # The sum over a word's bytes, moved to the start: the same wherever the word stands.
    return mix((sums[ends] - sums[starts]) * down[starts]), starts


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and where each text's begin and the last end."""
    joined = b" ".join(raws).translate(_WORD_BYTES)
    offsets = np.cumsum([0, *(len(r) + 1 for r in raws)])
    found, places, at = [], [], 0
    while at < len(joined):
        to = joined.find(b" ", at + _BLOCK)
        to = len(joined) if to < 0 else to
        hashes, starts = _block_hashes(joined[at:to])
        found.append(hashes)
        places.append(starts + at)
        at = to
    if not found:
        return np.empty(0, np.uint64), np.zeros(len(raws) + 1, np.int64)
    return np.concatenate(found), np.searchsorted(np.concatenate(places), offsets)
