"""A table of last values, in buckets with versions (T2), and reads of single buckets.

Rows are dealt into a fixed number of buckets by a hash of their key. A batch of changed
rows reads the buckets that it touches, replaces the rows with its keys, writes these
buckets anew, and publishes all of them at once by a manifest, which names the folder of
each bucket's newest version. Readers open as many folders as there are buckets, however
many batches there were, and a reader that knows the keys it wants opens only theirs.

The set of touched buckets is collected to the driver; it has ``buckets`` numbers at most.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallystream.streaming.manifest import Manifests

BUCKET = "bucket_of_key"  # the partition column of the files
KEEP_SECONDS = 24 * 3600.0


class Snapshot:
    def __init__(
        self,
        root: str,
        keys: list[str],
        schema: StructType,
        buckets: int = 32,
        keep_seconds: float = KEEP_SECONDS,
    ):
        """``schema`` has the keys and the values; ``buckets`` must not change later."""
        self.root = root.rstrip("/")
        self.keys, self.schema, self.buckets = list(keys), schema, buckets
        self.keep_seconds = keep_seconds

    def put(self, changed: DataFrame, query_id: str, batch_id: int) -> None:
        """Replace the rows of the changed keys; ``changed`` has one row a key.

        One query writes a snapshot. A replayed batch changes nothing.
        """
        spark = changed.sparkSession
        manifests = Manifests(spark, self.root, self.keep_seconds)
        last, content = manifests.latest()
        if content and content["query"] != query_id:
            raise ValueError(f"query {content['query']} writes {self.root}, not {query_id}")
        if last >= batch_id:
            return
        if content and content["buckets"] != self.buckets:
            raise ValueError(f"{self.root} has {content['buckets']} buckets, not {self.buckets}")
        folders = content.get("folders", {})
        rows = changed.select(*(F.col(f.name).cast(f.dataType) for f in self.schema))
        # Used twice, and a stateful batch would run again each time.
        rows = rows.withColumn(BUCKET, self._bucket()).persist()
        try:
            folders = content.get("folders", {})
            touched = self._touched(rows)
            folder = manifests.new_folder(batch_id)
            self._replace(rows, self._paths(folders, touched), f"{self.root}/{folder}")
        finally:
            rows.unpersist()
        new = {str(b): f"{folder}/{BUCKET}={b}" for b in touched}
        replaced = [folders[b] for b in new if b in folders]
        content = {"query": query_id, "buckets": self.buckets, "folders": {**folders, **new}}
        manifests.commit(batch_id, content, replaced)

    def _replace(self, rows: DataFrame, old: list[str], path: str) -> None:
        """Write the touched buckets: the stored rows with other keys, and the new ones."""
        if old:
            stored = self._read(rows.sparkSession, old).withColumn(BUCKET, self._bucket())
            keys = rows.select(*self.keys)
            same = [stored[k].eqNullSafe(keys[k]) for k in self.keys]
            rows = stored.join(keys, same, "left_anti").unionByName(rows)
        # One shuffle by bucket, so that a bucket is one file unless it is large.
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)

    def read(self, spark: SparkSession, touched_by: DataFrame | None = None) -> DataFrame:
        """The rows as of now; those of the buckets that hold keys of a frame, if one is given.

        Such a read gives all rows of the buckets; the join that follows picks the keys.
        """
        folders = Manifests(spark, self.root, self.keep_seconds).latest()[1].get("folders", {})
        wanted = None
        if touched_by is not None:  # a hash depends on the type
            typed = (F.col(k).cast(self.schema[k].dataType) for k in self.keys)
            wanted = self._touched(touched_by.select(*typed))
        paths = self._paths(folders, wanted)
        return self._read(spark, paths) if paths else spark.createDataFrame([], self.schema)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _touched(self, rows: DataFrame) -> list[int]:
        found = rows.select(self._bucket().alias("b")).distinct().collect()  # at most ``buckets``
        return sorted(r.b for r in found)

    def _paths(self, folders: dict[str, str], buckets: list[int] | None) -> list[str]:
        wanted = folders if buckets is None else [str(b) for b in buckets if str(b) in folders]
        return [f"{self.root}/{folders[b]}" for b in wanted]

    def _read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        return spark.read.schema(self.schema).parquet(*paths)
