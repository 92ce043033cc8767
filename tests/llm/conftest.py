import os

import duckdb
import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x" for i in range(60_000))
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4),
    (4, "Éa! x", "fr", "a", 5), (4, "Éa! x", "fr", "a", 5), (4, "other words here", "fr", "b", 16),
    (None, "no id at all in this row", "en", "b", 24), (None, None, None, None, None),
    (5, LONG, "en", "b", len(LONG)), (6, LONG, "en", None, len(LONG)),
]


@pytest.fixture(scope="module")
def odd_table(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing columns."""
    frame = spark.createDataFrame(ODD, DOCUMENTS)
    names = ("key", "k", "n", "of", "full", "mark", "length", "seen", "id", "by", "hash", "part",
             "fails", "first", "word", "block", "keep_id", "kept", "raw", "digest")
    for name in names:
        frame = frame.withColumn(name, F.lit("x"))
    return frame


@pytest.fixture(scope="module")
def equals_sql(spark, sf_dir):
    """Checks a registered query against its SQL over the whole tables, as the driver does."""
    import __spark_entry__ as driver

    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf_dir}/{file}'")

    def check(name):
        result = driver.queries()[name](spark, sf_dir)
        columns = sorted(result.columns)
        mine = sorted((tuple(r) for r in result.select(*columns).collect()), key=repr)
        answer = connection.execute(driver.oracle_sql()[name])
        names = [d[0] for d in answer.description]
        assert sorted(names) == columns
        order = [names.index(c) for c in columns]
        theirs = sorted((tuple(r[i] for i in order) for r in answer.fetchall()), key=repr)
        assert mine == theirs and mine

    return check
