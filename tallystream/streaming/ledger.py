"""Additive upsert into parquet files (K1, K2 without a database).

Spark's file sinks append or overwrite; they cannot add to a stored row. So
each micro-batch writes its own pre-aggregated rows as a run of its own, and a
reader adds the runs up. What a batch costs depends on the batch, not on how
many users are stored.

Runs have levels. A batch is a run of level 0. The batch that makes ``fold_every``
runs of a level writes their sum as one run of the next level instead, and so on
upwards in the same write. A row is thus rewritten once a level: what is rewritten per
batch grows with the logarithm of the number of batches, and readers open fewer than
``fold_every`` runs a level.

Each commit has a manifest, numbered by the batch, that names all runs (``manifest``).
A repeated batch finds its manifest and writes nothing. Folders are named by the query's
id, which Spark keeps in the checkpoint: a new checkpoint is a new query, whose batches
add to what is there. Runs that were folded stay for ``keep_seconds``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.streaming.manifest import Manifests, children

KEEP_SECONDS = 24 * 3600.0


class Ledger:
    def __init__(
        self,
        root: str,
        keys: list[str],
        sums: list[str],
        firsts: list[str] = (),
        fold_every: int = 8,
        keep_seconds: float = KEEP_SECONDS,
    ):
        """``sums`` are added up per key; of ``firsts`` the least value stays.

        Less than two runs cannot be folded: a smaller ``fold_every`` counts as two.
        """
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.sums = list(sums)
        self.firsts = list(firsts)
        self.fold_every = max(2, fold_every)
        self.keep_seconds = keep_seconds

    def add(self, delta: DataFrame, query_id: str, batch_id: int) -> None:
        """Add one batch; ``delta`` is aggregated by the keys already."""
        spark = delta.sparkSession
        manifests = self._manifests(spark, query_id)
        last, content = manifests.latest()
        if last >= batch_id:
            return  # a replay of a batch that counts already
        runs = content.get("runs", [])
        folded, level = self._to_fold(runs)
        rows = delta.select(*self.keys, *self.sums, *self.firsts)
        if folded:
            rows = self._total(self._read(spark, manifests, folded).unionByName(rows))
        folder = manifests.new_folder(batch_id)
        rows.write.parquet(f"{manifests.root}/{folder}")
        kept = [run for run in runs if run not in folded]
        new = {"folder": folder, "level": level, "batch": batch_id}
        # Another attempt that was faster has written the same rows.
        manifests.commit(batch_id, {"runs": [*kept, new]}, [run["folder"] for run in folded])

    def read(self, spark: SparkSession, together: str | None = None) -> DataFrame:
        """The stored rows, one per key, as of now. Fails if no batch has been written.

        ``together`` names one of the keys by which the caller groups next: rows
        that share it are then put in one partition by the one shuffle of this
        read. They are aggregated per batch already, so there are as many as the
        group has keys, times the runs.
        """
        folders = []
        for name in children(spark, self.root):
            if name.startswith("query-"):
                manifests = self._manifests(spark, name.removeprefix("query-"))
                runs = manifests.latest()[1].get("runs", [])
                folders += [f"{manifests.root}/{run['folder']}" for run in runs]
        if not folders:
            raise FileNotFoundError(f"no complete batch below {self.root}")
        rows = spark.read.parquet(*folders)
        return self._total(rows if together is None else rows.repartition(together))

    def batches(self, spark: SparkSession) -> int:
        """Commits so far, of all queries: a batch without rows is one, too."""
        names = [n for n in children(spark, self.root) if n.startswith("query-")]
        ids = (name.removeprefix("query-") for name in names)
        return sum(self._manifests(spark, one).latest()[0] + 1 for one in ids)

    def _manifests(self, spark: SparkSession, query_id: str) -> Manifests:
        return Manifests(spark, f"{self.root}/query-{query_id}", self.keep_seconds)

    def _to_fold(self, runs: list[dict]) -> tuple[list[dict], int]:
        """The runs whose levels the next batch completes, and the level of their sum."""
        folded, level = [], 0
        while True:
            same = [run for run in runs if run["level"] == level]
            if len(same) < self.fold_every - 1:
                return folded, level
            folded += same
            level += 1

    def _read(self, spark: SparkSession, manifests: Manifests, runs: list[dict]) -> DataFrame:
        return spark.read.parquet(*(f"{manifests.root}/{run['folder']}" for run in runs))

    def _total(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(
            *(F.sum(c).alias(c) for c in self.sums),
            *(F.min(c).alias(c) for c in self.firsts),
        )
