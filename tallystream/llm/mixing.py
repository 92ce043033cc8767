"""Mixing sources to target weights by capped water-filling, in DataFrame functions.

The sources, by code point with null last, get the weights in turn. The mix
takes a share of all words. A source's part is its weight's share of the mix,
but at most ``epochs`` times the source. Sources above that are clamped, and what
they leave is shared among the others by weight, until none is above: the level of
the open sources is (mix - clamped caps) / open weights, and rises with each round.

A source's documents are read whole, floor(target / size) times each, and a
seeded choice once more: in the order of a hash of the row as many as fit into
the rest, and one of the others whose size is nearest to what is left then, if
that comes nearer. The bound on the hash is found in two steps: sums over ranges
of hashes, then the rows of the one range that holds the bound. No source passes
through one task, and reruns agree. The mix is thus less than one document off the
target, unless the source's rows are all longer than what is left.

Equal rows have one hash. Where the choice falls within such a group, the number of
its rows that are taken once more is counted, and the group is written out anew from
its count: it does not matter which of equal rows these are.

Null texts have size 0, and any column may be null. Sources without words have target 0;
an empty table gives no rows. Two sources of equal cap per weight are clamped in one
round. Long texts are counted in one expression. Extra columns may have any name:
``mix_documents`` keeps all, ``mix_plan`` reads doc_id, source and text, and tells rows
apart by these alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.llm.texts import freed_shuffles, freed_tables, new_names, stored

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
EPOCHS = 2
SEED = 42
RANGE_ROWS = 4096  # rows of a hash range, about
BROADCAST_SOURCES = 10_000  # sources up to which their table is broadcast
COPIES_AT_ONCE = 10_000  # equal rows that one row is written out to in a step


def n_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def chance(docs: DataFrame, names: list[str], seed: int) -> Column:
    """A seeded hash of the named columns from 0 to 2^62 - 1, the same in every run."""

    def hashable(name: str) -> Column:
        kind = docs.schema[name].dataType
        plain = isinstance(kind, T.AtomicType) and not isinstance(kind, T.VariantType)
        return docs[name] if plain else F.to_json(F.struct(docs[name]))

    # A null's place is hashed as well: xxhash64 passes over nulls.
    columns = [c for name in names for c in (docs[name].isNull(), hashable(name))]
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 2)


def _numbered(totals: DataFrame) -> DataFrame:
    """Sources with ``place``, from 0 by code point with null last, without one task for all."""
    spread = totals.withColumn("last", F.col("source").isNull())
    spread = stored(
        spread.repartitionByRange("last", "source").withColumn("range", F.spark_partition_id())
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = spread.groupBy("range").agg(F.count("*").alias("rows"))  # a row a task
    ranges = ranges.select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("last", "source"))
    spread = spread.join(ranges, "range").withColumn("place", F.col("before") + inside - 1)
    return spread.drop("last", "range", "before")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...], share_percent: int, epochs: int
) -> DataFrame:
    """Per source: source_size, source_rows, and its target."""
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows")
    )
    place = F.pmod(F.col("place"), F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))
    ranked = _numbered(totals).withColumn("weight", weight).drop("place")
    ranked = stored(ranked.withColumn("cap", epochs * F.col("source_size")))
    mix = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share_percent / 100
    level, clamped = 0.0, -1
    while True:
        above = F.col("weight") * level > F.col("cap")
        found = ranked.agg(
            F.count(F.when(above, 1)).alias("n"),
            F.sum(F.when(above, F.col("cap"))).alias("caps"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
        ).first()
        if found.n == clamped or not found.open:
            break
        clamped, level = found.n, max(level, (mix - (found.caps or 0)) / found.open)
    part = F.col("weight") * level
    # All are clamped where the mix asks for more than all sources have.
    full = F.lit(not found.open) | (part > F.col("cap"))
    target = F.when(full, F.col("cap").cast("double")).otherwise(part)
    target = F.when(F.col("cap") > 0, target).otherwise(0.0)
    return ranked.select("source", "source_size", "source_rows", target.alias("target"))


def bounds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: ``whole`` repetitions, the greatest hash of which all rows are read once
    more, and ``some``: up to two hashes beyond it with the number k of their n rows that are.
    """
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    parts = F.greatest(F.lit(1), F.ceil(F.col("source_rows") / RANGE_ROWS))
    goal = stored(
        targets.select(
            F.col("source").alias("of"),
            "source_size",
            "target",
            whole.cast("long").alias("whole"),
            (F.col("target") - whole * F.col("source_size")).alias("need"),
            parts.cast("long").alias("parts"),
        )
    )
    few = goal.count() <= BROADCAST_SOURCES

    def by_source(frame: DataFrame, right: DataFrame, *more: Column) -> DataFrame:
        on = F.col("source").eqNullSafe(F.col("of"))
        for condition in more:
            on = on & condition
        return frame.join(F.broadcast(right) if few else right, on).drop("of")

    filled = sizes.filter("size > 0")
    part = F.floor(F.col("hash") / ((1 << 62) / F.col("parts"))).alias("part")
    units = by_source(filled, goal).select("source", "hash", "size", "need", part)
    sums = units.groupBy("source", "part", "need").agg(F.sum("size").alias("held"))
    upto = F.sum("held").over(Window.partitionBy("source").orderBy("part"))
    sums = sums.withColumn("before", upto - F.col("held"))
    # The range in which the need is reached, and its rows.
    edge = sums.filter("before <= need AND before + held > need")
    edge = stored(edge.select(F.col("source").alias("of"), F.col("part").alias("edge"), "before"))
    inside = by_source(units, edge, F.col("part") == F.col("edge"))
    inside = inside.groupBy("source", "hash", "before", "need").agg(
        F.sum("size").alias("held"), F.max("size").alias("size"), F.count("*").alias("n")
    )
    upto = F.col("before") + F.sum("held").over(Window.partitionBy("source").orderBy("hash"))
    fits = F.col("upto") <= F.col("need")
    # The first group of equal rows that does not fit whole, and how many of them do.
    rest = F.col("need") - F.col("upto") + F.col("held")
    k = F.floor(rest / F.col("size")).cast("long")
    group = F.struct("hash", k.alias("k"), "n", (rest - k * F.col("size")).alias("rest"))
    bound = (
        inside.withColumn("upto", upto)
        .groupBy("source")
        .agg(F.max(F.when(fits, F.col("hash"))).alias("bound"), F.min(F.when(~fits, group)).alias("group"))
    )
    bound = stored(
        bound.select(
            F.col("source").alias("of"),
            F.coalesce("bound", F.col("group.hash") - 1).alias("bound"),
            "group",
            F.col("group.rest").alias("rest"),
        )
    )
    # One more row, the nearest in size to the rest, if that is better than none.
    off = F.abs(F.col("size") - F.col("rest"))
    free = (F.col("hash") != F.col("group.hash")) | (F.col("group.k") < F.col("group.n"))
    near = by_source(filled, bound, F.col("hash") > F.col("bound"), off < F.col("rest"), free)
    near = near.groupBy("source").agg(F.min(F.struct(off.alias("off"), "hash")).alias("near"))
    near = near.select(F.col("source").alias("of"), F.col("near.hash").alias("near"))
    n = by_source(filled, stored(near), F.col("hash") == F.col("near"))
    n = n.groupBy("source", "near").agg(F.count("*").alias("near_n"))
    n = n.select(F.col("source").alias("by"), "near", "near_n")
    bound = bound.join(n, bound["of"].eqNullSafe(F.col("by")), "left").drop("by")
    same = F.coalesce(F.col("near") == F.col("group.hash"), F.lit(False))
    some = F.array_compact(
        F.array(
            F.when(
                (F.col("group.k") > 0) | same,
                F.struct("group.hash", (F.col("group.k") + same.cast("long")).alias("k"), "group.n"),
            ),
            F.when(
                F.col("near").isNotNull() & ~same,
                F.struct(F.col("near").alias("hash"), F.lit(1).cast("long").alias("k"), F.col("near_n").alias("n")),
            ),
        )
    )
    bound = bound.select("of", "bound", some.alias("some"))
    frame = goal.withColumnRenamed("of", "source")
    return frame.join(bound, frame["source"].eqNullSafe(bound["of"]), "left").select(
        "source",
        "source_size",
        "target",
        "whole",
        F.coalesce("bound", F.lit(-1)).alias("bound"),  # a source without words
        F.col("some"),
    )


def _planned(
    docs: DataFrame,
    names: list[str],
    weights: tuple[int, ...],
    share_percent: int,
    epochs: int,
    seed: int,
) -> tuple[DataFrame, dict[str, str]]:
    """Rows of docs, none lost, with four more columns: size, source_size, target, and how
    often the mix reads the row. Also the names of these columns, which docs does not have.
    """
    wanted = ("size", "hash", "of", "source_size", "target", "whole", "bound", "some", "times", "number")
    new = dict(zip(wanted, new_names(docs.columns, *wanted)))
    spark = docs.sparkSession
    with freed_shuffles(spark), freed_tables(spark):
        sizes = stored(
            docs.select(
                "source", n_words(F.col("text")).alias("size"), chance(docs, names, seed).alias("hash")
            )
        )
        plan = stored(bounds(sizes, source_targets(sizes, weights, share_percent, epochs)), keep=True)
    plan = plan.select(
        F.col("source").alias(new["of"]),
        *(F.col(c).alias(new[c]) for c in ("source_size", "target", "whole", "bound", "some")),
    )
    right = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    rows = docs.withColumn(new["size"], n_words(F.col("text")))
    rows = rows.withColumn(new["hash"], chance(docs, names, seed))
    rows = rows.join(right, rows["source"].eqNullSafe(F.col(new["of"])))
    hash_, whole, some = (F.col(new[c]) for c in ("hash", "whole", "some"))
    more = (hash_ <= F.col(new["bound"])) | F.exists(
        F.coalesce(some, F.array()), lambda one: (one["hash"] == hash_) & (one["k"] == one["n"])
    )
    times = whole + F.when(more & (F.col(new["size"]) > 0), 1).otherwise(0)
    # Of equal rows of which some are taken, one stays here and is written out n times.
    parts = F.filter(F.coalesce(some, F.array()), lambda one: (one["hash"] == hash_) & (one["k"] < one["n"]))
    if plan.filter(F.exists(new["some"], lambda one: one["k"] < one["n"])).isEmpty():
        return rows.withColumn(new["times"], times), new
    others = rows.filter(F.size(parts) == 0).withColumn(new["times"], times)
    equal = rows.filter(F.size(parts) > 0).dropDuplicates([new["of"], new["hash"]])
    group, number = F.element_at(parts, 1), F.col(new["number"])
    steps = F.sequence(F.lit(0).cast("long"), group["n"] - 1, F.lit(COPIES_AT_ONCE).cast("long"))
    equal = equal.withColumn(new["number"], F.explode(steps)).repartition(new["number"])
    last = F.least(number + COPIES_AT_ONCE, group["n"]) - 1
    equal = equal.withColumn(new["number"], F.explode(F.sequence(number, last)))
    equal = equal.withColumn(new["times"], whole + F.when(number < group["k"], 1).otherwise(0))
    return others.unionByName(equal.drop(new["number"])), new


def mix_plan(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """Per document: doc_id, size, source_size, target of its source, and words taken."""
    docs = docs.select("doc_id", "source", "text")
    rows, new = _planned(docs, docs.columns, weights, share_percent, epochs, seed)
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(new["size"]).alias("size"),
        F.col(new["source_size"]).alias("source_size"),
        F.col(new["target"]).alias("target"),
        (F.col(new["size"]) * F.col(new["times"])).cast("long").alias("taken"),
    )


def mix_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The mix: every document as often as it is read, numbered from 1 in ``repetition``.

    Where docs has a column of that name, the number's is ``_repetition``, and so on.
    Rows of size 0 are read as often as their source is read whole.
    """
    names = docs.columns
    rows, new = _planned(docs, names, weights, share_percent, epochs, seed)
    times = F.col(new["times"])
    numbers = F.when(times > 0, F.sequence(F.lit(1), times.cast("int")))
    repetition = new_names(names, "repetition")[0]
    return rows.select(*(rows[c] for c in names), F.explode(numbers).alias(repetition))
