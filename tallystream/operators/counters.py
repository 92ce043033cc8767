"""JSON counter maps per user.

Counters are added as ``bigint``: the total of a busy user passes the range of
an int long before the counts of one message do.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.functions.messages import enclosed
from tallystream.functions.picks import user_key


def counter_map(text: Column) -> Column:
    """A JSON object as a map of texts; of a repeated key the last value wins.

    Any other text fails the query, left-over text after the object too; null is null.
    Spark's parser keeps repeated keys. They are rare, so the scan for a later
    occurrence runs only on maps that have one. The one-element ``transform``
    binds the parsed list to a name, which keeps the text parsed once.
    """
    whole, names, mark = enclosed(text, '"1"')
    root = f"{names} array<map<string,string>>"
    parsed = F.from_json(whole, root, {"mode": "FAILFAST", "allowSingleQuotes": "false"})
    shown = F.coalesce(F.substring(text, 1, 200), F.lit("null"))
    fail = F.raise_error(F.concat(F.lit("not one JSON object: "), shown))

    def checked(found: Column) -> Column:
        first, last = F.get(found, F.lit(0)), F.get(found, F.lit(1))
        single = (F.size(found) == 2) & first.isNotNull() & ~F.map_contains_key(first, mark)
        single = F.coalesce(single & F.map_contains_key(last, mark), F.lit(False))
        return F.when(text.isNull(), None).when(single, _last_wins(first)).otherwise(
            fail.cast("map<string,string>")
        )

    return F.transform(F.array(parsed[names]), checked)[0]


def _last_wins(counters: Column) -> Column:
    keys = F.map_keys(counters)
    later = lambda e, i: F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"])
    last = F.filter(F.map_entries(counters), lambda e, i: ~later(e, i))
    repeated = (F.size(keys) > 1) & (F.size(F.array_distinct(keys)) < F.size(keys))
    return F.when(repeated, F.map_from_entries(last)).otherwise(counters)


def explode_counters(df: DataFrame, column: str = "general_stats") -> DataFrame:
    """One row (user_id, key, value) per entry; a null map gives no row."""
    return df.select("user_id", F.explode(counter_map(F.col(column))).alias("key", "value"))


def sum_counters(entries: DataFrame) -> DataFrame:
    """A3: sum per (user, key). Values that are not integers fail the query."""
    return entries.groupBy("user_id", "key").agg(
        F.sum(_integer(F.col("value"))).alias("total")
    )


def _integer(value: Column) -> Column:
    message = F.concat(F.lit("counter is not an integer: "), value.cast("string"))
    parsed = value.try_cast("bigint")
    fail = F.raise_error(message).cast("bigint")
    return F.when(value.isNull(), F.lit(None)).otherwise(F.coalesce(parsed, fail))


def counters_to_json(
    sums: DataFrame, *also: Column, column: str = "general_stats", together: bool = False
) -> DataFrame:
    """A4: the sums of a user as one JSON object, keys in order.

    Its input has one row per user and key, so what is collected for a user is
    its own map, the size of the document that is written. ``also`` are further
    aggregates per user. A row without key adds nothing to the map.

    A user's keys come from different tasks, so lists started before the shuffle
    would hold about one entry each and cost more than the rows: the rows are
    shuffled instead. ``together`` says that the rows of a user already are in
    one partition.
    """
    rows = sums if together else sums.repartition("user_id")
    entry = F.when(F.col("key").isNotNull(), F.struct("key", "total"))
    entries = F.array_sort(F.collect_list(entry))
    text = F.to_json(F.map_from_entries(entries), {"ignoreNullFields": "false"})
    return rows.groupBy("user_id").agg(text.alias(column), *also)


def touched_only(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """Stored rows of the users that have new rows.

    No broadcast is forced: Spark broadcasts the user ids if it measures them
    to be small, else both sides are hash-partitioned.
    """
    return stored.join(delta.select("user_id").distinct(), "user_id", "left_semi")


def lookup_stored(
    delta: DataFrame, stored: DataFrame, column: str = "general_stats"
) -> DataFrame:
    """Each row of ``delta`` with its user's stored map, null if absent."""
    known = stored.select("user_id", F.col(column).alias("stored"))
    return delta.join(known, "user_id", "left")


def merge_counters(delta: DataFrame, stored: DataFrame) -> DataFrame:
    """A5: stored and new maps added key by key, for the users with new rows.

    Keys of either side survive, common keys add. ``delta`` may hold many rows
    per user. A new row with an empty map still gives its user's stored map.

    Both sides go into one bag, whose rows say which side they are from, and are added
    up once per user and key; then a user's keys become a map if any row was new. So each
    side is read once and nothing is joined. An empty or null new map leaves a row without
    key, which says no more than that.
    """
    entries = F.explode_outer(counter_map(F.col("general_stats"))).alias("key", "value")
    fresh = delta.select("user_id", entries).withColumn("is_new", F.lit(True))
    known = explode_counters(stored.where("user_id IS NOT NULL")).withColumn("is_new", F.lit(False))
    sums = (
        fresh.unionByName(known)
        .groupBy("user_id", "key")
        .agg(F.sum(_integer(F.col("value"))).alias("total"), F.max("is_new").alias("is_new"))
    )
    merged = counters_to_json(
        sums, F.max("is_new").alias("is_new"), F.count("key").alias("keys")
    )
    return merged.where("is_new AND keys > 0").drop("is_new", "keys")


def insert_defaults(rows: DataFrame, created: Column | None = None) -> DataFrame:
    """the full row of a user, as it is stored the first time.

    ``created`` is the time of that first insert, by default now.
    """
    empty = F.lit("{}")
    when = F.current_timestamp() if created is None else created
    return rows.select(
        user_key(F.col("user_id")).alias("user_fkey"),
        "user_id",
        "general_stats",
        F.lit(1).alias("version"),
        when.alias("created"),
        when.alias("updated"),
        empty.alias("details"),
        empty.alias("this_week"),
        empty.alias("last_week"),
        empty.alias("last_30_days"),
        empty.alias("last_90_days"),
    )
