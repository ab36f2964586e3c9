"""Every registered query against its SQL on DuckDB: names, types and values."""

import pytest

import harness
from etlkit.plans.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(data):
    return harness.connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, data, name):
    problems, count, _ = harness.check(spark, db, data, name)
    assert not problems
    assert count > 0


def test_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert len(ORACLES) >= 0.85 * len(QUERIES)
    assert entry.entry(spark).columns[:2] == ["year", "month"]
