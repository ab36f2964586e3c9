import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import harness  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # The warehouse goes to a fresh folder, so that repeated runs do not meet old tables.
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", f"--conf spark.sql.warehouse.dir={tempfile.mkdtemp(prefix='wh-')} pyspark-shell")
    session = harness.make_session()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"


@pytest.fixture()
def table(spark, data):
    return lambda name: spark.read.parquet(f"{data}/{name}.parquet")


def executed_plan(df) -> str:
    """The plan that ran, after adaptive changes."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(r) for r in df.collect())
