import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"{shared}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def folder():
    """A new folder; it is left for the system to clean up."""
    return tempfile.mkdtemp(prefix="run-")


def pick(user, risk=100, state=501, currency=333, **more):
    """A pick message as text."""
    fields = {
        "user_fkey": f"fobj__sb_user_profile__{user}" if isinstance(user, int) else user,
        "risk_amount": risk,
        "settlement_state": state,
        "currency_code": currency,
        "created_stamp_millis_utc": 1712235175054,
    }
    fields.update(more)
    return json.dumps(fields)


def texts(spark, *messages):
    return spark.createDataFrame([(m,) for m in messages], "value string")


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
