"""Relational sinks: additive upsert, map merge and append.

Spark's JDBC writer can only append or overwrite. A batch is therefore written
in two steps:

1. Executors append its rows to a staging table in parallel, under the id of
   this attempt. A task that is retried or runs twice may insert a row twice,
   and a lost executor may insert late; ``SELECT DISTINCT`` on one attempt id
   undoes both, since rows are unique per key and computed alike each time.
2. The driver runs one short transaction: insert (query, batch) into a fence
   table, move the staged rows to the target with ``ON CONFLICT``, clear the
   staging table. If the fence row exists, the batch is done already.

The database sees one row per key and batch. Statements are PostgreSQL's. The
driver needs a DB-API connection without autocommit, passed in as ``connect``,
and Spark a JDBC driver on its class path.
"""

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.operators.counters import (
    counters_to_json,
    explode_counters,
    insert_defaults,
    sum_counters,
)
from tallystream.operators.totals import TOTALS
from tallystream.sources.stored import read_touched

FENCE_TABLE = """
CREATE TABLE IF NOT EXISTS stream_fence (
    query_id varchar(64), batch_id bigint, PRIMARY KEY (query_id, batch_id))
"""


def replayed(rows: DataFrame) -> None:
    """Runs a batch that is stored already: a stateful query must compute it, so that
    its state is committed along with the batch."""
    rows.write.format("noop").mode("overwrite").save()


@dataclass
class JdbcTarget:
    """A keyed table.

    ``add`` columns are added to the stored row, ``replace`` columns overwrite
    it, all others are written on first insert only. With no ``add`` and no
    ``replace`` rows are appended and ``key`` is not used. ``casts`` gives the
    database type of columns that travel as text.
    """

    options: dict[str, str]
    connect: Callable
    table: str
    columns: Sequence[str]
    key: str = "user_id"
    add: Sequence[str] = ()
    replace: Sequence[str] = ()
    casts: dict[str, str] = field(default_factory=dict)
    batch_rows: int = 100
    retries: int = 5
    pause: float = 1.0
    partitions: int = 16
    fence_ready: bool = field(default=False, init=False)

    @property
    def staging(self) -> str:
        return f"{self.table}_staging"

    def stage(self, rows: DataFrame, attempt: str) -> None:
        """Step 1, on the executors."""
        (
            rows.select(*self.columns, F.lit(attempt).alias("attempt_id"))
            .write.format("jdbc")
            .options(**self.options)
            .option("dbtable", self.staging)
            .option("batchsize", self.batch_rows)
            .option("numPartitions", self.partitions)
            .mode("append")
            .save()
        )

    def move_sql(self, attempt: str) -> str:
        """Staged rows of one attempt into the target."""
        names = ", ".join(self.columns)
        values = ", ".join(
            f"CAST(s.{c} AS {self.casts[c]})" if c in self.casts else f"s.{c}"
            for c in self.columns
        )
        sql = (
            f"INSERT INTO {self.table} ({names}) SELECT {values} FROM "
            f"(SELECT DISTINCT {names} FROM {self.staging} "
            f"WHERE attempt_id = '{attempt}') s WHERE true"
        )
        changes = [
            f"{c} = COALESCE({self.table}.{c}, 0) + EXCLUDED.{c}" for c in self.add
        ] + [f"{c} = EXCLUDED.{c}" for c in self.replace]
        if changes:
            sql += f" ON CONFLICT ({self.key}) DO UPDATE SET {', '.join(changes)}"
        return sql

    def write(self, rows: DataFrame, query_id: str, batch_id: int) -> None:
        """Write one batch, once. ``rows`` has one row per key."""
        if self.is_done(query_id, batch_id):
            replayed(rows)
            return
        attempt = new_attempt(query_id, batch_id)
        self.stage(rows, attempt)
        self.commit(attempt, query_id, batch_id)

    def commit(self, attempt: str, query_id: str, batch_id: int) -> None:
        """Step 2. A failed transaction is repeated, unless it did commit."""
        for trial in range(self.retries + 1):
            try:
                if trial > 0 and self.is_done(query_id, batch_id):
                    return
                self._transaction(
                    f"INSERT INTO stream_fence VALUES ('{query_id}', {int(batch_id)})",
                    self.move_sql(attempt),
                    f"DELETE FROM {self.staging} WHERE attempt_id LIKE '{query_id}/%'",
                )
                return
            except Exception:
                if trial == self.retries:
                    raise
                time.sleep(self.pause)

    def is_done(self, query_id: str, batch_id: int) -> bool:
        if not self.fence_ready:
            self._transaction(FENCE_TABLE)
            self.fence_ready = True
        connection = self.connect()
        try:
            cursor = connection.cursor()
            cursor.execute(
                "SELECT count(*) FROM stream_fence "
                f"WHERE query_id = '{query_id}' AND batch_id = {int(batch_id)}"
            )
            return cursor.fetchone()[0] > 0
        finally:
            connection.close()

    def _transaction(self, *statements: str) -> None:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            for sql in statements:
                cursor.execute(sql)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()


def new_attempt(query_id: str, batch_id: int) -> str:
    return f"{query_id}/{int(batch_id)}/{uuid.uuid4().hex}"


def totals_target(
    options: dict[str, str], connect: Callable, table: str, absolute: bool = False, **settings
) -> JdbcTarget:
    """K1: running totals, added to the stored row of the user.

    With ``absolute`` they replace it: for totals that a stream keeps itself
    (update mode) and has seen from the first pick on.
    """
    columns = ["user_id", *TOTALS]
    change = {"replace": TOTALS} if absolute else {"add": TOTALS}
    return JdbcTarget(options, connect, table, columns=columns, **change, **settings)


def windows_target(
    options: dict[str, str], connect: Callable, table: str, **settings
) -> JdbcTarget:
    """K3: closed windows, appended."""
    settings = {"batch_rows": 1000, **settings}
    columns = ["user_fkey", "window_start", "window_end", "total_risk_amount"]
    return JdbcTarget(options, connect, table, columns=columns, **settings)


JSON_COLUMNS = [
    "general_stats",
    "details",
    "this_week",
    "last_week",
    "last_30_days",
    "last_90_days",
]


@dataclass
class CounterTarget(JdbcTarget):
    """K2: counter maps merged key by key into the stored map of the user.

    The stored maps of the batch's users are read into Spark, merged there, and
    written back; ``created`` and the other defaults stay as first inserted.
    Between read and write no one else may change these users: one query per
    target table.
    """

    def stored(self, delta: DataFrame, attempt: str) -> DataFrame:
        low, high = delta.agg(F.min("user_id"), F.max("user_id")).first()
        return read_touched(
            delta.sparkSession,
            self.options,
            self.table,
            self.staging,
            attempt,
            (low or 0, high or 0),
            self.partitions,
        )

    def write(self, rows: DataFrame, query_id: str, batch_id: int) -> None:
        """Write one batch; ``rows`` is (user_id, key, total), one per user and key."""
        if self.is_done(query_id, batch_id):
            replayed(rows)
            return
        fresh = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = new_attempt(query_id, batch_id)
            users = fresh.select("user_id").distinct()
            no_map = F.lit(None).cast("string").alias("general_stats")
            self.stage(insert_defaults(users.select("user_id", no_map)), touched)
            entries = fresh.select(
                "user_id", "key", F.col("total").cast("string").alias("value")
            )
            known = explode_counters(self.stored(fresh, touched))
            merged = counters_to_json(sum_counters(entries.unionByName(known)))
            attempt = new_attempt(query_id, batch_id)
            self.stage(insert_defaults(merged), attempt)
            self.commit(attempt, query_id, batch_id)
        finally:
            fresh.unpersist()


def counters_target(
    options: dict[str, str], connect: Callable, table: str, **settings
) -> CounterTarget:
    """K2 with the columns of a stored user; JSON columns are cast by the database."""
    settings = {"casts": dict.fromkeys(JSON_COLUMNS, "json"), **settings}
    columns = [
        "user_fkey",
        "user_id",
        "general_stats",
        "version",
        "created",
        "updated",
        "details",
        "this_week",
        "last_week",
        "last_30_days",
        "last_90_days",
    ]
    return CounterTarget(
        options, connect, table, columns=columns, replace=["general_stats"], **settings
    )
