"""Read positions committed with the results they led to.

A checkpoint holds how far a query has read. Once it is lost, a new query starts at one
end of the topic: it counts everything again, or skips what came in between. Here the
next offset of each partition of a topic is stored in the manifest that makes a batch
count, so sums and positions cannot differ. A query with a new checkpoint drops the
records below the stored positions, and ``starting_offsets`` tells a topic reader to
start there, so that it does not fetch them again.

A partition's records must come in the order of their offsets from batch to batch, as a
topic gives them; within a batch any order will do. Records without topic, partition or
offset are refused, as they cannot be told from records that count already.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.streaming.ledger import Ledger
from tallystream.streaming.manifest import Manifests, delete

PLACE = ["topic", "partition"]
POSITIONS = "topic string, partition int, next_offset long"
# Read by Spark's topic source as the first record that is still there.
EARLIEST = -2


class PositionedLedger(Ledger):
    """A ledger shared by all queries that read the same topics for it.

    Its commits are numbered one after the other, whichever query makes them. Two queries
    may run at once: the one whose commit comes second looks again at what is new.
    """

    def add_records(
        self, records: DataFrame, query_id: str, batch_id: int, terms: Callable[[DataFrame], DataFrame]
    ) -> None:
        """Add the records of a batch that do not count yet.

        ``terms`` turns records into rows with the ledger's keys and columns, to be added
        up, and the topic, partition and offset of the record.
        """
        spark = records.sparkSession
        manifests = self._manifests(spark, "all")
        while True:
            last, content = manifests.latest()
            batches = content.get("batches", {})
            if batches.get(query_id, -1) >= batch_id:
                return
            fresh = terms(unread(records, self._positions(spark, manifests, content)))
            # A key's records are in few partitions: hardly more rows than keys.
            run = fresh.groupBy(*self.keys, *PLACE).agg(
                *(F.sum(c).alias(c) for c in self.sums),
                *(F.min(c).alias(c) for c in self.firsts),
                (F.max("offset") + 1).alias("next_offset"),
            )
            batch = manifests.new_folder(last + 1)
            run.write.parquet(f"{manifests.root}/{batch}")
            positions, sums = f"{batch}-positions", f"{batch}-sums"
            reached = self._reached(spark, manifests, content, batch)
            reached.write.parquet(f"{manifests.root}/{positions}")
            runs = content.get("runs", [])
            folded, level = self._to_fold(runs)
            new = {"folder": batch, "level": level, "batch": last + 1}
            replaced = [run["folder"] for run in folded]
            if folded:
                rows = self._total(self._read(spark, manifests, [*folded, new]))
                rows.write.parquet(f"{manifests.root}/{sums}")
                new["folder"] = sums
                replaced.append(batch)
            if "positions" in content:
                replaced.append(content["positions"])
            commit = {
                "runs": [*(run for run in runs if run not in folded), new],
                "positions": positions,
                "batches": {**batches, query_id: batch_id},
            }
            if manifests.commit(last + 1, commit, replaced):
                return
            # Another query or attempt was faster: what is new is not what it was.
            for name in (batch, positions, sums):
                delete(spark, f"{manifests.root}/{name}")

    def positions(self, spark: SparkSession) -> DataFrame:
        """(topic, partition, next_offset) as of the last commit."""
        manifests = self._manifests(spark, "all")
        return self._positions(spark, manifests, manifests.latest()[1])

    def starting_offsets(self, spark: SparkSession, partitions: dict[str, int]) -> dict:
        """Where a topic reader goes on, for ``start_options``.

        ``partitions`` is the number of partitions of each topic. One that has not been
        read yet starts at its first record. One row a partition comes to the driver.
        """
        start = {topic: {str(p): EARLIEST for p in range(n)} for topic, n in partitions.items()}
        for row in self.positions(spark).where(F.col("topic").isin(*partitions)).collect():
            start[row.topic][str(row.partition)] = row.next_offset
        return start

    def _positions(self, spark: SparkSession, manifests: Manifests, content: dict) -> DataFrame:
        if "positions" not in content:
            return spark.createDataFrame([], POSITIONS)
        return spark.read.schema(POSITIONS).parquet(f"{manifests.root}/{content['positions']}")

    def _reached(
        self, spark: SparkSession, manifests: Manifests, content: dict, batch: str
    ) -> DataFrame:
        """Positions after a new run: three columns of it, one row a partition of the topic."""
        run = spark.read.schema(POSITIONS).parquet(f"{manifests.root}/{batch}")
        known = self._positions(spark, manifests, content)
        return known.unionByName(run).groupBy(*PLACE).agg(F.max("next_offset").alias("next_offset"))


def unread(records: DataFrame, positions: DataFrame) -> DataFrame:
    """The records at or after the position of their partition; all of an unknown one."""
    placed = F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    offset = F.when(placed, F.col("offset")).otherwise(
        F.raise_error(F.lit("a record without topic, partition or offset")).cast("long")
    )
    known = positions.select(*PLACE, "next_offset").withColumnsRenamed({c: f"known_{c}" for c in PLACE})
    same = (F.col("topic") == F.col("known_topic")) & (F.col("partition") == F.col("known_partition"))
    rows = records.withColumn("offset", offset).join(known, same, "left")
    return rows.where(
        F.col("next_offset").isNull() | (F.col("offset") >= F.col("next_offset"))
    ).select(*records.columns)

