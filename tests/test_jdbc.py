"""The relational sinks' statements, fence and retries.

No database server runs here. The statements run in an in-process DuckDB, whose
``ON CONFLICT`` follows PostgreSQL's; the two JDBC transfers are replaced. So
these tests cover what is written and how often, not the JDBC transport.
"""

import json

import duckdb
import pytest

from tallystream.operators.totals import TOTALS
from tallystream.sources import file_topic
from tallystream.streaming import counters_job, totals_job
from tallystream.streaming.jdbc import (
    JSON_COLUMNS,
    CounterTarget,
    JdbcTarget,
    counters_target,
    totals_target,
    windows_target,
)
from tests.conftest import pick, texts


class Session:
    """A DB-API connection without autocommit; ``fail`` makes statements fail."""

    def __init__(self, database, fail):
        self.connection = database.cursor()
        self.connection.begin()
        self.fail = fail
        self.open = True

    def cursor(self):
        return self

    def execute(self, sql):
        if sql.startswith("INSERT INTO stream_fence") and self.fail.get("before", 0) > 0:
            self.fail["before"] -= 1
            raise OSError("connection lost")
        self.connection.execute(sql)

    def fetchone(self):
        return self.connection.fetchone()

    def commit(self):
        self.connection.commit()
        self.open = False
        if self.fail.get("after", 0) > 0:
            self.fail["after"] -= 1
            raise OSError("no answer to commit")

    def rollback(self):
        if self.open:
            self.connection.rollback()
            self.open = False

    def close(self):
        self.rollback()


class Local:
    """Transfers between Spark and the in-process database."""

    def stage(self, rows, attempt):
        from pyspark.sql import functions as F

        table = rows.select(*self.columns, F.lit(attempt).alias("attempt_id")).toArrow()
        cursor = self.database.cursor()
        cursor.register("incoming", table)
        for _ in range(self.copies):
            cursor.execute(f"INSERT INTO {self.staging} BY NAME SELECT * FROM incoming")

    def stored(self, delta, attempt):
        found = self.database.cursor().execute(
            f"SELECT user_id, CAST(general_stats AS varchar) FROM {self.table} WHERE user_id IN "
            f"(SELECT user_id FROM {self.staging} WHERE attempt_id = '{attempt}')"
        ).fetchall()
        return delta.sparkSession.createDataFrame(found, "user_id long, general_stats string")


class LocalTarget(Local, JdbcTarget):
    pass


class LocalCounters(Local, CounterTarget):
    pass


def local(make, kind, database, table, copies=1, fail=None, **settings):
    fail = {} if fail is None else fail
    target = make({}, lambda: Session(database, fail), table, pause=0, **settings)
    given = [k for k, f in target.__dataclass_fields__.items() if f.init]
    mine = kind(**{k: getattr(target, k) for k in given})
    mine.database, mine.copies = database, copies
    return mine


@pytest.fixture
def database():
    connection = duckdb.connect()
    totals = ", ".join(f"{c} bigint" for c in TOTALS)
    connection.execute(f"CREATE TABLE totals (user_id bigint PRIMARY KEY, {totals})")
    connection.execute(f"CREATE TABLE totals_staging (user_id bigint, {totals}, attempt_id varchar)")
    window = "user_fkey varchar, window_start timestamptz, window_end timestamptz, total_risk_amount float"
    connection.execute(f"CREATE TABLE windows ({window})")
    connection.execute(f"CREATE TABLE windows_staging ({window}, attempt_id varchar)")
    texts_ = ", ".join(f"{c} varchar" for c in JSON_COLUMNS)
    stats = (
        f"user_fkey varchar, {texts_}, version int, created timestamptz, updated timestamptz"
    )
    connection.execute(f"CREATE TABLE stats (user_id bigint PRIMARY KEY, {stats})")
    connection.execute(f"CREATE TABLE stats_staging (user_id bigint, {stats}, attempt_id varchar)")
    return connection


def totals_df(spark, *data):
    return spark.createDataFrame(list(data), ["user_id", *TOTALS])


def stored_totals(database):
    return database.execute("SELECT * FROM totals ORDER BY 1").fetchall()


def test_totals_are_added_to_stored_rows(spark, database):
    database.execute("INSERT INTO totals VALUES (1, 5, 50, 1, 1, 1), (9, 1, NULL, 0, 0, 0)")
    target = local(totals_target, LocalTarget, database, "totals")
    target.write(totals_df(spark, (1, 1, 5, 1, 0, 0), (2, 1, 7, 0, 0, 1), (9, 1, 3, 0, 0, 0)), "q", 0)
    assert stored_totals(database) == [
        (1, 6, 55, 2, 1, 1),
        (2, 1, 7, 0, 0, 1),
        (9, 2, 3, 0, 0, 0),
    ]
    assert database.execute("SELECT count(*) FROM totals_staging").fetchone() == (0,)


def test_replayed_batch_changes_nothing(spark, database):
    target = local(totals_target, LocalTarget, database, "totals")
    delta = totals_df(spark, (1, 1, 5, 1, 0, 0))
    target.write(delta, "q", 0)
    target.write(delta, "q", 0)
    assert stored_totals(database) == [(1, 1, 5, 1, 0, 0)]
    target.write(delta, "q", 1)
    target.write(delta, "other", 0)
    assert stored_totals(database) == [(1, 3, 15, 3, 0, 0)]


def test_absolute_totals_replace_the_stored_row(spark, database):
    target = local(totals_target, LocalTarget, database, "totals", absolute=True)
    target.write(totals_df(spark, (1, 1, 5, 1, 0, 0)), "q", 0)
    target.write(totals_df(spark, (1, 4, 9, 2, 1, 0)), "q", 1)
    target.write(totals_df(spark, (1, 1, 5, 1, 0, 0)), "q", 0)
    assert stored_totals(database) == [(1, 4, 9, 2, 1, 0)]


def test_rows_staged_twice_count_once(spark, database):
    target = local(totals_target, LocalTarget, database, "totals", copies=3)
    target.write(totals_df(spark, (1, 1, 5, 1, 0, 0)), "q", 0)
    assert stored_totals(database) == [(1, 1, 5, 1, 0, 0)]


def test_rows_of_a_dead_attempt_are_not_used(spark, database):
    database.execute("INSERT INTO totals_staging VALUES (1, 9, 9, 9, 9, 9, 'q/0/dead')")
    target = local(totals_target, LocalTarget, database, "totals")
    target.write(totals_df(spark, (1, 1, 5, 1, 0, 0)), "q", 0)
    assert stored_totals(database) == [(1, 1, 5, 1, 0, 0)]


@pytest.mark.parametrize("when", ["before", "after"])
def test_failed_transaction_is_repeated(spark, database, when):
    """Lost before the commit, or after it with the answer lost: once either way."""
    fail = {}
    target = local(totals_target, LocalTarget, database, "totals", fail=fail)
    target.write(totals_df(spark, (1, 1, 5, 1, 0, 0)), "q", 0)
    if when == "before":
        fail["before"] = 3
    if when == "after":
        fail["after"] = 1
    target.write(totals_df(spark, (1, 1, 5, 1, 0, 0)), "q", 1)
    assert stored_totals(database) == [(1, 2, 10, 2, 0, 0)]


def test_retries_are_bounded(spark, database):
    fail = {"before": 99}
    target = local(totals_target, LocalTarget, database, "totals", fail=fail, retries=2)
    with pytest.raises(OSError):
        target.write(totals_df(spark, (1, 1, 5, 1, 0, 0)), "q", 0)
    assert fail["before"] == 96
    assert stored_totals(database) == []


def test_windows_are_appended_once(spark, database):
    from datetime import datetime

    schema = "user_fkey string, window_start timestamp, window_end timestamp, total_risk_amount float"
    df = spark.createDataFrame(
        [("u", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 30), 5.0)], schema
    )
    target = local(windows_target, LocalTarget, database, "windows", copies=2)
    target.write(df, "q", 0)
    target.write(df, "q", 0)
    target.write(df, "q", 1)
    assert database.execute("SELECT user_fkey, total_risk_amount FROM windows").fetchall() == [
        ("u", 5.0),
        ("u", 5.0),
    ]
    assert "ON CONFLICT" not in target.move_sql("a")


def test_counter_maps_merge_and_defaults_stay(spark, database):
    database.execute(
        "INSERT INTO stats BY NAME SELECT 1 AS user_id, 'kept' AS user_fkey, 7 AS version, "
        "'{\"a\":1,\"b\":2}' AS general_stats, '{\"x\":1}' AS details, "
        "TIMESTAMPTZ '2020-01-01 00:00:00+00' AS created"
    )
    target = local(counters_target, LocalCounters, database, "stats", copies=2, casts={})
    delta = spark.createDataFrame(
        [(1, "b", 3), (1, "c", 4), (2, "a", 1)], "user_id long, key string, total long"
    )
    target.write(delta, "q", 0)
    target.write(delta, "q", 0)
    found = database.execute(
        "SELECT user_id, user_fkey, general_stats, version, details, year(created) > 2020 "
        "FROM stats ORDER BY 1"
    ).fetchall()
    assert found == [
        (1, "kept", '{"a":1,"b":5,"c":4}', 7, '{"x":1}', False),
        (2, "fobj__sb_user_profile__2", '{"a":1}', 1, "{}", True),
    ]
    target.write(delta, "q", 1)
    assert database.execute("SELECT general_stats FROM stats ORDER BY user_id").fetchall() == [
        ('{"a":1,"b":8,"c":8}',),
        ('{"a":2}',),
    ]


def test_json_columns_are_cast_by_the_database():
    target = counters_target({}, None, "stats")
    sql = target.move_sql("q/0/x")
    assert "CAST(s.general_stats AS json)" in sql
    assert sql.endswith(
        "ON CONFLICT (user_id) DO UPDATE SET general_stats = EXCLUDED.general_stats"
    )


def test_jobs_into_the_database(spark, database, folder):
    """Streams of several batches, with a failure after a batch was written."""
    picks = [pick(u, 10 * u, 511 + u % 3, 333 if u % 2 else 331) for u in range(6)] * 5
    texts(spark, *picks).repartition(4).write.text(f"{folder}/topic")
    totals = local(totals_target, LocalTarget, database, "totals")
    counters = local(counters_target, LocalCounters, database, "stats", casts={})
    for job, target, name in ((totals_job, totals, "t"), (counters_job, counters, "c")):
        fail_at = {2}

        def write(batch, query_id, batch_id, target=target, fail_at=fail_at):
            target.write(batch, query_id, batch_id)
            if batch_id in fail_at:
                fail_at.remove(batch_id)
                raise RuntimeError("lost after the write")

        for trial in range(2):
            query = job(
                file_topic(spark, f"{folder}/topic", max_files_per_trigger=1),
                write,
                name,
                f"{folder}/checkpoints",
                available_now=True,
            )
            if trial == 0:
                with pytest.raises(Exception, match="lost after the write"):
                    query.awaitTermination()
            else:
                query.awaitTermination()
    for user, n, staked, won, loss, push in stored_totals(database):
        counts = user % 2 == 1
        assert (n, staked) == (5 * counts, 50 * user * counts)
        state = 511 + user % 3
        assert (won, loss, push) == tuple(5 * counts * (state == s) for s in (511, 512, 513))
        text = database.execute(f"SELECT general_stats FROM stats WHERE user_id = {user}").fetchone()
        assert json.loads(text[0]) == {
            "won": won,
            "loss": loss,
            "push": push,
            "total_coins_staked": staked,
            "total_settled_picks": n,
        }
    assert len(stored_totals(database)) == 6


def test_closed_windows_into_the_database(spark, database, folder):
    """K3 on the stateful window job: each batch of closed windows once."""
    from tallystream.streaming import wait_closed, window_job
    from tallystream.streaming.jobs import each_batch

    texts(spark, pick(1, 5), pick(1, 6), pick(2, 7)).write.text(f"{folder}/topic")
    target = local(windows_target, LocalTarget, database, "windows", copies=2)

    def write_twice(batch, query_id, batch_id):
        target.write(batch, query_id, batch_id)
        target.write(batch, query_id, batch_id)

    query = window_job(
        file_topic(spark, f"{folder}/topic"),
        lambda df: each_batch(df, write_twice),
        "windows_db",
        f"{folder}/checkpoints",
        size="2 seconds",
        every="500 milliseconds",
    )
    wait_closed(query, size_seconds=2, timeout=60)
    found = database.execute(
        "SELECT user_fkey[-1], total_risk_amount, window_end - window_start = INTERVAL 2 SECONDS "
        "FROM windows ORDER BY 1"
    ).fetchall()
    assert found == [("1", 11.0, True), ("2", 7.0, True)]


def test_stream_totals_replace_stored_rows(spark, database, folder):
    """T2, stateful form, into a table: the stream's own totals, as they stand."""
    from tallystream.functions import parse_picks
    from tallystream.operators import contributions, user_totals
    from tallystream.streaming import launch
    from tallystream.streaming.jobs import each_batch

    texts(spark, *[pick(1, n, 511) for n in range(6)]).repartition(3).write.text(f"{folder}/topic")
    topic = file_topic(spark, f"{folder}/topic", max_files_per_trigger=1)
    target = local(totals_target, LocalTarget, database, "totals", absolute=True)
    totals = user_totals(contributions(parse_picks(topic)))
    writer = each_batch(totals, target.write).outputMode("update")
    launch(writer, "absolute", f"{folder}/c", available_now=True).awaitTermination()
    assert stored_totals(database) == [(1, 6, 15, 6, 0, 0)]
