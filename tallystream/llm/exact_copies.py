"""Exact copies by progressive refinement, in DataFrame functions.

Texts are equal when they are identical after lower-casing A-Z only. Of equal texts the
row with the largest doc_id stays. Three passes, each over what the last one left:

1. the bytes of each text are counted; a length that one row alone has ends there;
2. rows of the remaining lengths are told apart by a hash of their first characters;
3. rows whose length and prefix occur again are read whole, and classes are the rows
   with one SHA-256 of the normalised text.

Each pass hands the next one a set of keys, never texts. The set is broadcast where it
was counted to be at most ``BROADCAST_KEYS`` long integers; a longer one is not sent, and
the next pass then reads a superset, which gives the same classes. Counts and greatest
ids are aggregated in tasks before the shuffle, so a class that holds a third of all rows
arrives as one row a task. Rows find their class by a broadcast of the few large classes
(at most ``1 / HOT_SHARE``) and a shuffle of ids and hashes for the rest.

Null texts count as empty, and all empty texts are one class. A null doc_id is smaller
than any other; where all ids of a class are null, keep_id is null and its rows are
``kept``. Rows that repeat both text and the largest doc_id are all marked ``kept``;
``exact_distinct`` returns one of them. Very long texts are hashed whole. An empty table
gives no rows. Other columns may have any name: only doc_id and text are read by
``exact_copies``, and ``exact_distinct`` returns all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.texts import new_names, shared_checkpoints

PREFIX = 64  # characters that the second pass hashes
BROADCAST_KEYS = 500_000
HOT_SHARE = 0.001  # of all rows, from which on a class counts as large

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z, all else as it is. ASCII texts take the faster function."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _length_key() -> Column:
    return F.octet_length(_text()).cast("long")


def _prefix_key() -> Column:
    return F.xxhash64(F.octet_length(_text()), lower_ascii(F.substring(_text(), 1, PREFIX)))


def _again(rows: DataFrame, key: Column) -> DataFrame | None:
    """Keys that occur at least twice, checkpointed; None where they are too many to send."""
    keys = rows.groupBy(key.alias("k")).agg(F.count("*").alias("n")).filter("n > 1").select("k")
    keys = keys.checkpoint()
    return keys if keys.count() <= BROADCAST_KEYS else None


def _marked(rows: DataFrame, key: Column, keys: DataFrame | None, name: str) -> DataFrame:
    """Rows with a boolean: their key is one of the keys."""
    if keys is None:
        return rows.withColumn(name, F.lit(True))
    keyed, seen = new_names(rows.columns, "key", "seen")
    right = F.broadcast(keys.select(F.col("k").alias(seen)))
    marked = rows.withColumn(keyed, key).join(right, F.col(keyed) == F.col(seen), "left")
    return marked.withColumn(name, F.col(seen).isNotNull()).drop(keyed, seen)


def _survivors(docs: DataFrame, name: str) -> DataFrame:
    """The rows of docs with a boolean: length and prefix occur again. Reads docs twice."""
    length = new_names([*docs.columns, name], "length")[0]
    lengths = _again(docs.select("text"), _length_key())
    rest = _marked(docs.select("text"), _length_key(), lengths, length).filter(length)
    prefixes = _again(rest, _prefix_key())
    marked = _marked(docs, _length_key(), lengths, length)
    if prefixes is None:
        return marked.withColumnRenamed(length, name)
    # A row whose length is its own is never looked up by its prefix.
    key = F.when(F.col(length), _prefix_key())
    return _marked(marked, key, prefixes, name).drop(length)


def _classed(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, full, ...) with keep_id and group_size; ``full`` null is its own class."""
    classes = (
        rows.filter("full IS NOT NULL")
        .groupBy(F.col("full").alias("class"))
        .agg(F.count("*").alias("size"), F.max("doc_id").alias("keep"))
        .filter("size > 1")
        .checkpoint()
    )
    on = F.col("full") == F.col("class")
    if classes.count() <= BROADCAST_KEYS:
        found = rows.join(F.broadcast(classes), on, "left")
    else:
        large = F.broadcast(classes.filter(F.col("size") > HOT_SHARE * rows.count()))
        found = rows.join(large, on).unionByName(
            rows.join(large, on, "left_anti").join(classes, on, "left")
        )
    alone = F.col("class").isNull()
    return found.select(
        *rows.columns,
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep"))).alias("kept"),
    )


def exact_copies(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, and text_sha256 of the normalised text.

    The digest of a row that no other can equal is computed for this column alone.
    """
    shared_checkpoints(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    digest = F.sha2(lower_ascii(_text()).cast("binary"), 256)
    narrow = _survivors(rows, "survives").select(
        "doc_id", F.when(F.col("survives"), digest).alias("full"), digest.alias("text_sha256")
    )
    found = _classed(narrow.checkpoint())
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def exact_distinct(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; whole texts are hashed for survivors
    only. What is dropped is found by an anti-join on id and hash."""
    shared_checkpoints(docs.sparkSession)
    mark, hashed, key, gone_key, gone = new_names(docs.columns, "mark", "full", "id", "by", "hash")
    full = F.sha2(lower_ascii(_text()).cast("binary"), 256)
    marked = _survivors(docs, mark).withColumn(hashed, F.when(F.col(mark), full))
    marked = marked.withColumn(key, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    narrow = marked.filter(mark).select(
        F.col("doc_id"), F.col(key).alias("key"), F.col(hashed).alias("full")
    )
    classed = _classed(narrow.checkpoint()).checkpoint()

    def without(frame: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        right = keys.select(F.col("key").alias(gone_key), F.col("full").alias(gone))
        right = F.broadcast(right) if right.count() <= BROADCAST_KEYS // 10 else right
        on = (F.col(key) == F.col(gone_key)) & (F.col(hashed) == F.col(gone))
        return frame.join(right, on, how)

    dropped = classed.filter("NOT kept").select("key", "full").distinct().checkpoint()
    stay = without(marked, dropped, "left_anti")
    again = classed.filter("kept AND group_size > 1").groupBy("key", "full").count()
    again = again.filter("count > 1").checkpoint()
    if not again.isEmpty():
        once = without(stay, again, "left_semi").dropDuplicates([key, hashed])
        stay = without(stay, again, "left_anti").unionByName(once)
    return stay.select(*docs.columns)
