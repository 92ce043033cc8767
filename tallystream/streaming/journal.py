"""An append-only record of batches whose parts are committed together.

A batch may have several parts, such as good and bad messages, or window sums and late
rows. They are written below one folder and count from one manifest on, so that a reader
never sees one part of a batch without the others, and a replayed batch counts once.
A small state, such as a watermark, is committed with them.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallystream.operators.windows import WINDOW_SIZE
from tallystream.streaming.manifest import Manifests

PART = "part_of_batch"


class Journal:
    """The batches of one query below a folder."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def add(
        self, spark: SparkSession, batch_id: int, write: Callable[[str], None], state: dict | None = None
    ) -> None:
        """Commit what ``write`` puts below the folder it is given."""
        manifests = Manifests(spark, self.root, keep_seconds=0.0)
        last, content = manifests.latest()
        if last >= batch_id:
            return
        folder = manifests.new_folder(batch_id)
        write(f"{self.root}/{folder}")
        folders = [*content.get("folders", []), folder]
        manifests.commit(batch_id, {"folders": folders, "state": state or {}}, [])

    def add_parts(self, rows: DataFrame, part: str, batch_id: int) -> None:
        """Commit rows by the text in column ``part``: one pass over them, one write."""
        named = rows.withColumnRenamed(part, PART)
        self.add(
            rows.sparkSession, batch_id, lambda path: named.write.partitionBy(PART).parquet(path)
        )

    def state(self, spark: SparkSession) -> dict:
        return Manifests(spark, self.root, 0.0).latest()[1].get("state", {})

    def folders(self, spark: SparkSession) -> list[str]:
        """The folders of all batches so far."""
        folders = Manifests(spark, self.root, 0.0).latest()[1].get("folders", [])
        return [f"{self.root}/{folder}" for folder in folders]

    def read(self, spark: SparkSession, part: str, schema: StructType) -> DataFrame:
        """The rows of a part in all batches so far."""
        paths = [f"{folder}/{PART}={part}" for folder in self.folders(spark)]
        jvm, conf = spark.sparkContext._jvm, spark._jsc.hadoopConfiguration()
        found = []
        for path in paths:  # a batch may have no rows of this part
            at = jvm.org.apache.hadoop.fs.Path(path)
            if at.getFileSystem(conf).exists(at):
                found.append(path)
        return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def split_batch(journal: Journal, judge: Callable[[DataFrame], DataFrame], part: str):
    """A batch writer: judged rows into the parts that their column names."""
    return lambda batch, query_id, batch_id: journal.add_parts(judge(batch), part, batch_id)


class EventWindows:
    """Sums in windows of the rows' own time, with the late rows in a table of their own.

    A batch's watermark is the greatest time of all earlier batches less ``delay``. Rows
    whose window ends at or before it are late: that window was closed. Spark's own
    watermark drops such rows; here they are kept, with the batch they came in. Sums of a
    batch are added to those before when they are read, and the watermark is committed
    with both, so that a replayed batch is judged as it was.
    """

    def __init__(self, root: str, key: str, value: str, on: str, delay: str, size: str = WINDOW_SIZE):
        self.journal = Journal(root)
        self.key, self.value, self.on, self.delay, self.size = key, value, on, delay, size

    def write(self, batch: DataFrame, query_id: str, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = self.journal.state(spark).get("watermark")
        window = F.window(self.on, self.size)
        rows = batch.select(self.key, self.value, self.on, window.alias("w")).persist()
        try:
            ends = F.col("w.end").cast("timestamp_ntz")
            late = F.lit(False) if mark is None else ends <= F.lit(mark).cast("timestamp_ntz")
            late = F.coalesce(late, F.lit(False))
            newest = F.max(F.col(self.on)) - F.expr(f"INTERVAL {self.delay}")
            newest = rows.agg(newest.cast("string").alias("mark")).first().mark
            marks = [m for m in (mark, newest) if m is not None]
            sums = rows.where(~late).groupBy(
                self.key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")
            ).agg(F.sum(self.value).alias("total"), F.count("*").alias("rows"))

            def both(path: str) -> None:
                sums.write.parquet(f"{path}/{PART}=sums")
                rows.where(late).drop("w").write.parquet(f"{path}/{PART}=late")

            state = {"watermark": max(marks, default=None)}
            self.journal.add(spark, batch_id, both, state)
        finally:
            rows.unpersist()

    def closed(self, spark: SparkSession, schema: StructType, until: str | None = None) -> DataFrame:
        """Windows (key, window_start, window_end, total, rows) that are closed by now, or by
        ``until`` if that is given; a window in ``until`` or later may still grow."""
        mark = until or self.journal.state(spark).get("watermark")
        sums = self.journal.read(spark, "sums", schema)
        done = F.col("window_end").cast("timestamp_ntz") <= F.lit(mark).cast("timestamp_ntz")
        return sums.where(done).groupBy(self.key, "window_start", "window_end").agg(
            F.sum("total").alias("total"), F.sum("rows").alias("rows")
        )

    def late(self, spark: SparkSession, schema: StructType) -> DataFrame:
        return self.journal.read(spark, "late", schema)
