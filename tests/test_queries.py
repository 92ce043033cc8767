"""Every registered query against its SQL, as the driver compares them."""

import duckdb
import pytest

import __spark_entry__ as driver
from tallystream.plans import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'"
        )
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, oracle, name):
    result = driver.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    mine = sorted((tuple(r) for r in result.select(*columns).collect()), key=repr)

    answer = oracle.execute(driver.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in answer.fetchall()), key=repr)
    assert mine == theirs
    assert mine


def test_entry(spark):
    assert driver.entry(spark).count() > 0
